"""Regional time panels on Spark: scan, reshape, join, report and forecast.

Every operator is a plain function from DataFrames to a DataFrame.  Nothing is
cached or collected unless a function says so (only model fitting does).
"""
