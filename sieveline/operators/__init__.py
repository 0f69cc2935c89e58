"""Table-to-table operators: every function takes and returns DataFrames."""
