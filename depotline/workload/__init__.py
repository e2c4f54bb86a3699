"""The benchmark workload: one named query per operator, with an SQL check where SQL can express it."""
