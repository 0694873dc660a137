"""Training-data operators: mixing, scans, deduplication, quality, packing.

Every operator takes and returns DataFrames.  Python runs only inside Spark
tasks on Arrow batches; shuffles, grouping and joins are Spark's.  Nothing
else in the library imports this subpackage.
"""
