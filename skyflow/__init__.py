"""Flight and weather stream analytics as plain Spark DataFrame functions."""
