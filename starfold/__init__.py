"""Company-investment warehouse jobs as plain Spark DataFrame functions."""
