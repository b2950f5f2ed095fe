"""Edge-table reduction on Spark DataFrames: rules, keyed sampling, matching, geometry, properties."""
