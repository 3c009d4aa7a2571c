"""Run parameters, kept as data rather than code."""

from __future__ import annotations

from dataclasses import dataclass, field

# Fixed values that must equal the analysed project's vocabulary when its own
# words are wanted (subject codes -> names, effect labels, confidence labels).
REFERENCE_SUBJECT_NAMES = {
    "disciplina_1": "Português",
    "disciplina_2": "Ciências",
    "disciplina_3": "Inglês",
    "disciplina_4": "Matemática",
}
REFERENCE_EFFECT_LABELS = (
    "forte_positivo",
    "moderado_positivo",
    "indistinguivel",
    "moderado_negativo",
    "forte_negativo",
)
REFERENCE_CONFIDENCE_LABELS = ("significativo", "inconclusivo")

# Default (English) labels used by this library.
EFFECT_LABELS = (
    "strong_positive",
    "moderate_positive",
    "indistinct",
    "moderate_negative",
    "strong_negative",
)
CONFIDENCE_LABELS = ("significant", "inconclusive")


@dataclass(frozen=True)
class Params:
    """Frozen analysis parameters.

    ``subject_map`` maps wide measure columns to subject names; the effect and
    confidence labels are ordered strong+ .. strong- and significant,
    inconclusive.
    """

    min_obs_per_student: int = 4
    min_subjects_per_student: int = 2
    subject_map: dict = field(
        default_factory=lambda: {
            "subject_1": "subject_1",
            "subject_2": "subject_2",
            "subject_3": "subject_3",
            "subject_4": "subject_4",
        }
    )
    grade_range: tuple = (0.0, 10.0)
    eda_grade_range: tuple = (-0.2, 10.2)
    pct_range: tuple = (0.0, 100.0)
    valid_terms: tuple = (1, 2, 3, 4)
    max_orphan_share_classes: float = 0.05
    max_orphan_share_scores: float = 0.01
    weak_cut: float = 0.10
    strong_cut: float = 0.30
    z: float = 1.96
    effect_labels: tuple = EFFECT_LABELS
    confidence_labels: tuple = CONFIDENCE_LABELS
    mean_effect_range: tuple = (-0.1, 0.1)
    stdev_effect_range: tuple = (0.0, 2.0)
    effect_range: tuple = (-5.0, 5.0)
    zero_sum_tol: float = 1e-6
    monotone_tol: float = 1e-6
    # None ranks the raw value; an int ranks round(value, n) so that engines
    # that differ in the last ulp still agree on ties.
    rank_round_digits: int | None = None
    target: str = "dev"

    @property
    def subjects(self) -> list[str]:
        return list(dict.fromkeys(self.subject_map.values()))


def reference_vocabulary(**overrides) -> Params:
    """Params using the analysed project's own subject names and labels."""
    base = dict(
        subject_map=dict(REFERENCE_SUBJECT_NAMES),
        effect_labels=REFERENCE_EFFECT_LABELS,
        confidence_labels=REFERENCE_CONFIDENCE_LABELS,
    )
    base.update(overrides)
    return Params(**base)
