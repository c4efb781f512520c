"""Column functions: all JVM-side, no Python UDF."""
