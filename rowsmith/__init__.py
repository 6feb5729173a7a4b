"""Data quality and test data on Spark: profile, judge, repair and generate tables."""
