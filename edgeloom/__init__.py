"""Edge-table analytics on Spark: ingest, rankings, user reports, ledgers and lineage figures.

Every operator is a function from DataFrames to a DataFrame. None of them runs
an action or collects rows; the caller decides when and where results are
written.
"""
