"""Column functions: keyed random numbers and bins."""
