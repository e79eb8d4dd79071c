"""Column-to-column building blocks. All of them are native Spark expressions."""
