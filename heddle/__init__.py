"""heddle: building, checking and comparing large annotated tables on Spark.

An annotated table is a bundle of DataFrames that share row ids (observations)
and column ids (features).  Every operator takes DataFrames plus column names
and returns DataFrames.
"""
