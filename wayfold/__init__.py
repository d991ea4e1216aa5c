"""Road-network analytics on Spark: DataFrame operators, sources, functions and plans."""
