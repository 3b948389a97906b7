"""Readers: partitioned paths, JSON lines, logs, delimited text, change images, JDBC extracts."""
