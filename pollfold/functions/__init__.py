"""Column expressions. All are native Spark expressions but the Adler-32 checksum, which is an Arrow function."""
