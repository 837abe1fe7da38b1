"""tallyfold: reconciliation, temporal and training-data operators on Spark DataFrames."""
