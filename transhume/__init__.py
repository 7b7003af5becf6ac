"""Table migration on Spark: DataFrame-in, DataFrame-out operators and exports."""
