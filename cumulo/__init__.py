"""Cloud inventory and metric lakehouse jobs on Spark DataFrames."""
