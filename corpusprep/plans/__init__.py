"""Jobs (compositions of operators) and the query catalogue."""
