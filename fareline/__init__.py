"""fareline: monthly trip records on Spark, from raw files to marts."""
