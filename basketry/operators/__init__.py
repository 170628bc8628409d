"""Analytics operators: DataFrames in, one lazy DataFrame out."""
