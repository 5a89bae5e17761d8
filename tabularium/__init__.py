"""Analytics operators on Spark DataFrames: relational, time, nested data, quality, storage, loads, marts, streams."""
