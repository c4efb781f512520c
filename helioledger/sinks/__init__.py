"""Where DataFrames go: daily JSON, CSV, the raw table, marts."""
