"""Training-data operators: corpus cleaning, search, tokenization and archives.

Every operator is a function from DataFrames to a DataFrame.  Python runs only
inside Arrow batches, over arrays of word hashes; Spark partitions, shuffles
and joins.  Nothing outside this folder imports it.
"""
