"""Detection analytics on Spark: boxes, matches, metrics, dataset checks and run logs as DataFrame operators."""
