"""textmill: preparing and analysing large text corpora with Spark DataFrames."""
