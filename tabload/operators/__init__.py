"""Table operators: every operator takes and returns DataFrames and runs no action itself
unless its docstring says so."""
