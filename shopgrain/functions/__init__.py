"""Column -> Column building blocks; no Python UDF in any of them."""
