"""Plan shapes shared by the operators: segments, running values, intervals."""
