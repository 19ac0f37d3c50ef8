"""Column expressions of the mart. All are built-in Spark functions; there are no UDFs."""
