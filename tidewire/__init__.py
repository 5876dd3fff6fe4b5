"""Social-platform event analytics expressed as Spark DataFrame transforms."""
