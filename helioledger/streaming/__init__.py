"""Collection and daily sums as streams over arriving reading files."""
