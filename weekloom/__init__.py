"""Weekly retail demand analytics on Spark DataFrames, SQL and ML."""
