"""Measured signals and scores from large collections of transcripts, on Spark DataFrames."""
