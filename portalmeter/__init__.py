"""Usage and catalogue reporting for an open-data portal, on Spark DataFrames."""
