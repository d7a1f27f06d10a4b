"""Long-format statistical panels (entity x period x topic -> value) on Spark DataFrames."""
