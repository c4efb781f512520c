"""Where DataFrames come from: reading files, reference tables, marts."""
