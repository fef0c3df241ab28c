"""lathe — a Spark-native engine for shaping imperfect tabular data into
evaluated models: profiling, cleaning, imputation, fuzzy entity filters,
leakage-safe splits, fit-on-train encoders and scalers, class rebalancing,
distributed training and SQL-checkable evaluation aggregates.

Every operator is a function ``DataFrame -> DataFrame`` (or a fitted table
plus an apply step) so Catalyst sees one declarative plan per step.
"""

from lathe.session import get_spark, stage_table, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
