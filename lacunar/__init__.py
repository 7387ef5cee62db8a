"""Gap filling of gridded time series, and a library of data operators, on Spark DataFrames."""
