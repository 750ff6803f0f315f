"""The inputs, queries and SQL checks behind ``__spark_entry__``."""
