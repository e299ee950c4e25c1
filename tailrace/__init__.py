"""Topic logs on Spark: read, write, tail, audit and count append-only message files."""
