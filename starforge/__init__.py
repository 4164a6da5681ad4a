"""starforge: warehouse building, analytics, data quality and text retrieval on Spark DataFrames."""
