"""Portfolio and basket analytics on PySpark DataFrames.

Sources read and write tables, functions build columns, operators take and
return DataFrames, plans chain operators into whole jobs.
"""
