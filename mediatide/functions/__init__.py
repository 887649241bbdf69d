"""Column expressions.  All of them stay in the JVM; there is no Python UDF in this package."""
