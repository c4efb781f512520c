"""Energy-readings analytics on Spark.

Hourly readings of grid, panels, battery and household use go in; money saved,
export income and the payback forecast come out.  Every function takes and
returns DataFrames, so Catalyst sees one plan from the raw files to the marts.
"""

__version__ = "0.1.0"
