"""The billing operators; each takes and returns lazy DataFrames."""
