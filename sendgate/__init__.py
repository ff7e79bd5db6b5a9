"""sendgate: decide who may be notified, batch the allowed rows, dispatch and log them.

Every operator takes DataFrames and returns DataFrames; Spark plans, shuffles and runs the work.
"""
