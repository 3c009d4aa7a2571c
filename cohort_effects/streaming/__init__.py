"""Streaming entry points.

The analysed project is batch-only (full-replace loads); its one declared
incremental idea -- rebuild only the year partitions that received new data
-- is provided here as a Structured Streaming job (``refresh``).  ``deltas``
goes further: it keeps the model's sums and rebuilds nothing.
"""

from cohort_effects.streaming.refresh import affected_years, refresh_years, start_year_refresh  # noqa: F401
