"""Word analytics over tables and streams, as plain Spark DataFrame code."""
