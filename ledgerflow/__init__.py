"""Payment analytics on Spark DataFrames: CSV drops to an audit table to report tables."""
