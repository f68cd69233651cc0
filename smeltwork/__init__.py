"""Control-table-driven bronze / silver / gold processing on PySpark DataFrames."""
