"""The layered movie warehouse: each table is a function of DataFrames."""
