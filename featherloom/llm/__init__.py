"""Operators of a training-data pipeline: extraction, filters, deduplication, search, mixing.

Every operator takes and returns DataFrames. Rows move between Spark stages; numpy works
inside tasks on Arrow buffers. Tables written between steps go to the shared folder that
``spark.checkpoint.dir`` names.
"""
