"""Column-expression helpers. All are built-in Spark expressions (codegen, no Python UDF)."""
