"""Table operators: each takes DataFrames and returns a DataFrame, unless it fits something."""
