"""tabkit: Spark-native operators for learning from mixed numeric / categorical tables.

Every public operator takes and returns Spark DataFrames. Fitting steps
(`fit_*`) collect only small, size-checked parameter rows (medians, means,
dictionaries); the data itself never passes through the driver.

Layout
------
sources/    scans and sinks (CSV with/without header, text lines, parquet tables)
functions/  column expressions (number grammar, portable hash, labels) and
            distributed helpers (exact quantiles, global running totals)
operators/  profiling, feature preparation, splits, models, evaluation,
            tuning, experiments, chart data
plans/      fixtures derived from the test tables and the query catalog
            (Spark query + DuckDB oracle SQL side by side)
streaming/  micro-batch scoring of arriving files with a fitted preparation
"""

__all__ = ["session"]
