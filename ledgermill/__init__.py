"""Document and transaction warehouse jobs written as Spark DataFrame code."""
