"""The whole build, source tables to the effect mart, as one lazy plan."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import cached_property

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohort_effects.operators import effects as fx
from cohort_effects.operators import enrich, staging
from cohort_effects.operators.ranges import written
from cohort_effects.params import Params
from cohort_effects.plans import fixtures
from cohort_effects.sources import read_table


@dataclass
class Layers:
    """Every model layer as a lazy DataFrame (a view until written).  What later
    layers read more than once is written on first use, so that it is made once: the
    bridges for the context and their checks, the context (grades with school and
    year) for the enriched and the demeaned rows and their statistics, the moments for
    the effects, twice for the variances and again for the mart.  The mart's rows are checkpointed on their way to the
    ranks.  A ``make_`` gives a layer from the one before."""

    students: DataFrame | None
    scores: DataFrame
    attendance: DataFrame
    classes: DataFrame
    make_bridge: Callable[[], DataFrame]
    make_years: Callable[[], DataFrame]
    make_context: Callable[[DataFrame, DataFrame, list[int] | None], DataFrame]
    make_enriched: Callable[[DataFrame], DataFrame]
    make_demeaned: Callable[[DataFrame], DataFrame]
    make_moments: Callable[[DataFrame], DataFrame]
    make_variances: Callable[[DataFrame], DataFrame]
    make_mart: Callable[[DataFrame], DataFrame]

    @cached_property
    def bridge(self) -> DataFrame:
        return self.make_bridge()

    @cached_property
    def years(self) -> DataFrame:
        return self.make_years()

    @cached_property
    def context(self) -> DataFrame:
        return self.make_context(self.bridge, self.years, None)

    @cached_property
    def enriched(self) -> DataFrame:
        return self.make_enriched(self.context)

    @cached_property
    def demeaned(self) -> DataFrame:
        return self.make_demeaned(self.context)

    @cached_property
    def moments(self) -> DataFrame:
        return self.make_moments(self.demeaned)

    @cached_property
    def effects(self) -> DataFrame:
        from cohort_effects.operators.quality import enforce_contract
        from cohort_effects.sources.schemas import EFFECTS_SCHEMA

        return enforce_contract(self.moments.select(*EFFECTS_SCHEMA.fieldNames()), EFFECTS_SCHEMA)

    @cached_property
    def variances(self) -> DataFrame:
        return self.make_variances(self.moments)

    @cached_property
    def mart(self) -> DataFrame:
        return self.make_mart(self.moments)

    def mart_of(self, years: list[int]) -> DataFrame:
        """The mart's rows of some years; the others are not built (a student's
        mean is of one year)."""
        return self.make_mart(self.make_moments(self.make_demeaned(self.make_context(self.bridge, self.years, years))))


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage by writing the layer as a Parquet table under
    ``spark.checkpoint.dir`` (a shared folder on a cluster) and reading it
    back: a lost executor never forces a recompute from the sources, and
    later readers get column pruning and filter pushdown on the copy."""
    return written(df, "layer")


def build_layers(
    raw_scores: DataFrame,
    raw_attendance: DataFrame,
    raw_classes: DataFrame,
    raw_students: DataFrame | None = None,
    params: Params = Params(),
    materialize: Callable[[DataFrame], DataFrame] | None = None,
    materialize_model: bool = True,
) -> Layers:
    """All layers as lazy DataFrames.

    ``materialize`` (e.g. ``checkpointed``) is applied to every layer that
    later layers or checks read more than once, and the following layers are
    built on the materialised result.  ``materialize_model=False`` leaves the
    model layers (demeaned .. mart) lazy, for callers that write them as
    tables themselves (``run_build``).
    """
    m = materialize
    scores, attendance, classes, students = _each(m, [
        staging.clean_scores(raw_scores, measures=list(params.subject_map)),
        staging.clean_attendance(raw_attendance),
        staging.clean_classes(raw_classes),
        staging.clean_students(raw_students) if raw_students is not None else None,
    ])
    return _layers_from_clean(scores, attendance, classes, students, params, m, materialize_model)


def _each(m, dfs: list) -> list:
    """Apply ``m`` to independent layers, one after the other: when ``m`` materialises,
    each fills the cluster by itself, and only one layer's shuffle files lie on disk."""
    return [m(d) if m and d is not None else d for d in dfs]


def _layers_from_clean(scores, attendance, classes, students, params: Params, m, materialize_model=True) -> Layers:
    """Everything after the cleaners (bridges, enrichment, model)."""
    from cohort_effects.operators.quality import enforce_contract
    from cohort_effects.sources import schemas as S

    made = [enforce_contract(enrich.class_school_bridge(attendance), S.BRIDGE_SCHEMA), enrich.class_year(classes)]
    if m:
        made = _each(m, made)
    mm = m if m and materialize_model else (lambda d: d)

    def make_context(bridge: DataFrame, years: DataFrame, only: list[int] | None) -> DataFrame:
        if m:  # all layers are wanted: the students' statistics are made once, before the
            # unpivot, for the enriched and the demeaned rows alike, and written with them
            whole = enrich.attach_context(scores, bridge, years, params.subject_map, statistics=True)
            return whole if only is None else whole.where(F.col("year").isin(only))
        whole = enrich.attach_context(scores, bridge, years, params.subject_map)
        return checkpointed(whole if only is None else whole.where(F.col("year").isin(only)))

    def make_enriched(context: DataFrame) -> DataFrame:
        enriched = enrich.enrich_scores(context, None, None, params.subject_map, attached=True)
        return enforce_contract(enriched, S.ENRICHED_SCHEMA)  # with statistics, columns of the written context

    def make_demeaned(context: DataFrame) -> DataFrame:
        # The flag and the demeaning statistics share one (student, year)
        # aggregate: for rows with a year both are over the same partition.
        demeaned = fx.demean(
            context,
            min_obs=params.min_obs_per_student,
            min_groups=params.min_subjects_per_student,
            flag_target="school_id",
            group_values=sorted(set(params.subject_map.values())),
            deal=True,  # a student has one score row a term
        ).select(
            "student_id", "class_id", "year", "term", "subject", "school_id",
            "grade", "student_mean", "grade_dm", "n_obs_student", "multi_school",
        )
        return mm(enforce_contract(demeaned, S.DEMEANED_SCHEMA))

    return Layers(
        students, scores, attendance, classes, lambda: made[0] if m else checkpointed(made[0]),
        lambda: made[1] if m else checkpointed(made[1]), make_context, make_enriched, make_demeaned,
        lambda demeaned: checkpointed(fx.group_moments(demeaned)),
        lambda moments: mm(enforce_contract(fx.variance_components(moments), S.VARIANCES_SCHEMA)),
        lambda moments: mm(fx.score_effects(moments, None, params)),
    )


def fixture_layers(
    spark: SparkSession, base: str, params: Params = Params(), materialize=None, materialize_model: bool = True
) -> Layers:
    """Layers over the driver tables through the fixture adapters."""
    li = read_table(spark, base, "lineitem")
    students = fixtures.raw_student(read_table(spark, base, "orders"), read_table(spark, base, "customer"))
    return build_layers(
        fixtures.raw_score(li), fixtures.raw_attendance(li), fixtures.raw_class(li), students, params, materialize,
        materialize_model,
    )


def source_layers(
    spark: SparkSession,
    base: str,
    names: dict | None = None,
    params: Params | None = None,
    materialize=None,
    materialize_model: bool = True,
) -> Layers:
    """Layers straight from the analysed project's raw tables.

    ``names`` maps the roles student / roster / attendance / score to file
    names under ``base`` (``{name}.parquet``); raw column names come from
    ``SOURCE_COLUMNS`` and the wide score columns from ``params.subject_map``.
    """
    from cohort_effects.params import reference_vocabulary
    from cohort_effects.operators.quality import ContractError, source_drift
    from cohort_effects.sources.schemas import SOURCE_COLUMNS, SOURCE_SCHEMAS

    p = params or reference_vocabulary()
    names = names or {"student": "aluno", "roster": "turma", "attendance": "frequencia", "score": "avaliacao"}
    m = materialize
    raw = {role: read_table(spark, base, fname) for role, fname in names.items()}
    for role, df in raw.items():  # undeclared columns may come; declared ones must be there
        gone = [c for c, issue, _ in source_drift(df, SOURCE_SCHEMAS[role]) if issue == "missing" and c in _read_columns(role, p)]
        if gone:
            raise ContractError(f"source {names[role]} lacks {gone}")
    sc, ac, rc, stc = (SOURCE_COLUMNS[k] for k in ("score", "attendance", "roster", "student"))
    scores, attendance, classes, students = _each(m, [
        staging.clean_scores(raw["score"], measures=list(p.subject_map), **sc),
        staging.clean_attendance(raw["attendance"], **ac),
        staging.clean_classes(raw["roster"], **rc),
        staging.clean_students(raw["student"], **stc) if "student" in raw else None,
    ])
    return _layers_from_clean(scores, attendance, classes, students, p, m, materialize_model)


def _read_columns(role: str, params: Params) -> set[str]:
    """Raw columns that the cleaners of a source read."""
    from cohort_effects.sources.schemas import SOURCE_COLUMNS

    unread = {"class_id"} if role == "student" else set()
    columns = {raw for name, raw in SOURCE_COLUMNS[role].items() if name not in unread}
    return columns | set(params.subject_map) if role == "score" else columns


def effect_mart(
    raw_scores: DataFrame,
    raw_attendance: DataFrame,
    raw_classes: DataFrame,
    params: Params = Params(),
) -> DataFrame:
    """The flagship: (school, subject, year) shrunken effects, 14 columns."""
    return build_layers(raw_scores, raw_attendance, raw_classes, None, params).mart


DETAIL_CLUSTER = ("subject", "school_id")
MART_CLUSTER = ("subject", "effect_class", "school_id")


def run_build(
    layers: Layers,
    out_root: str,
    params: Params = Params(),
    gate_on_errors: bool = True,
) -> DataFrame:
    """Materialise the two table layers, test them, then publish: the full build.

    * S8: each layer goes to its own table under ``out_root``
      (``intermediate/demeaned``, ``marts/effects``).  Both are written as a new
      version (``sources.versions``) that readers see only after the gate.
    * Q12/Q13: the mart is checked against its contract, and a NOT NULL
      guard inside the write fails the job before the table is committed.
    * S6/S7: both tables are partitioned by year and laid out in files that
      readers can skip; the detail's row counts come from the context layer.
    * Q19: the suite runs on the new versions; error failures raise, and the
      published ones stay.  Row-level checks of the two tables (not null, between,
      mean, deviation) are observed while they are written, not scanned for.

    Returns the check results.
    """
    from cohort_effects.operators import quality as Q
    from cohort_effects.plans import suite as SU
    from cohort_effects.sources.clustered import write_clustered
    from cohort_effects.sources.schemas import MART_SCHEMA, NOT_NULL_DEMEANED, NOT_NULL_MART
    from cohort_effects.sources.versions import discard, new_version, publish

    spark = layers.scores.sparkSession
    root = out_root.rstrip("/")
    dm_path, mart_path = new_version(f"{root}/intermediate/demeaned"), new_version(f"{root}/marts/effects")
    generic = SU.generic_checks(params)
    seen = {t: (Observation(f"{t}-{dm_path[-12:]}"), Q.row_level_metrics(generic, t)) for t in ("demeaned", "mart")}
    published = False
    try:
        counts = layers.context.where(F.col("year").isNotNull()).groupBy("year", *DETAIL_CLUSTER).agg(F.count("*").alias("n"))
        write_clustered(Q.assert_not_null(layers.demeaned, NOT_NULL_DEMEANED), dm_path, DETAIL_CLUSTER,
                        sort_by=["student_id", "term"], counts=counts, observe=seen["demeaned"])
        demeaned = spark.read.schema(layers.demeaned.schema).parquet(dm_path).select(*layers.demeaned.columns)
        # level-1 moments are mart-sized; writing them once keeps the effect and
        # variance checks from re-aggregating the whole detail table each time
        moments = checkpointed(fx.group_moments(demeaned))
        mart = Q.enforce_contract(fx.score_effects(moments, None, params), MART_SCHEMA)
        write_clustered(Q.assert_not_null(mart, NOT_NULL_MART), mart_path, MART_CLUSTER, observe=seen["mart"])
        mart = spark.read.schema(MART_SCHEMA).parquet(mart_path).select(*MART_SCHEMA.fieldNames())
        built = replace(layers, make_context=lambda bridge, years, only: layers.context, make_enriched=lambda context: layers.enriched,
                        make_demeaned=lambda context: demeaned, make_moments=lambda detail: moments, make_mart=lambda sums: mart)
        measured = {name: n for observed, metrics in seen.values() if metrics for name, n in observed.get.items()}
        results = Q.run_checks(SU.suite(built, params), SU.tables_of(built), params.target, measured)
        results = results.checkpoint(eager=True)
        if gate_on_errors:
            Q.gate(results)
        publish(spark, dm_path)
        publish(spark, mart_path)
        published = True
    finally:
        if not published:
            discard(spark, dm_path)
            discard(spark, mart_path)
    return results
