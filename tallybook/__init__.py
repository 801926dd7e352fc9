"""Table, attempt-log and result-set analytics written as Spark DataFrame functions."""
