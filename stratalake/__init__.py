"""A medallion warehouse (raw -> staging -> analytics) built from Spark DataFrames."""
