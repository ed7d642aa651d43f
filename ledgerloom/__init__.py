"""Bank-transaction analytics as Spark DataFrame operators."""
