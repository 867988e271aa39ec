"""Archive analytics on Spark: DataFrame operators, sources, functions, plans."""
