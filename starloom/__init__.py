"""Galaxy-schema analytics warehouse for marketplace orders, built on Spark DataFrames."""
