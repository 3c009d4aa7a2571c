"""Column-expression helpers (all JVM-side, codegen friendly)."""

from cohort_effects.functions.columns import (  # noqa: F401
    band,
    clamp_nonneg,
    code_to_name,
    hex_id,
    no_neg_zero,
    parse_date,
    round_double,
    round_half_up,
    safe_double,
    safe_int,
    trim_ws,
)
