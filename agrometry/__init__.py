"""Agricultural climate risk on Spark DataFrames.

Every operator takes DataFrames and returns a lazy DataFrame; nothing here
collects data, and the row path holds no Python functions.
"""
