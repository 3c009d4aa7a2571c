"""cohort_effects: group-effect estimation, data quality and profiling on Spark.

Every operator is a plain ``DataFrame -> DataFrame`` function (usable with
``df.transform``) written with built-in ``pyspark.sql.functions`` so the whole
plan stays inside Catalyst and whole-stage codegen.  Column names are
parameters, so the same operators run on any table.
"""

from cohort_effects.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
