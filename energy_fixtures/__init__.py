"""The driver's tables in the shape of energy readings, the registered queries and their oracles."""
