"""Fitment catalogue tables on Spark: DataFrame in, DataFrame out."""
