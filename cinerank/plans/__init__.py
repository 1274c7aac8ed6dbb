"""Plans: job-level compositions of the operators and the query catalogue."""
