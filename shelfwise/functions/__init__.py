"""Column expressions; every one runs inside generated JVM code."""
