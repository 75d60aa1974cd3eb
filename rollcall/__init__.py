"""rollcall: a member warehouse for streams and batches, built on PySpark DataFrames."""
