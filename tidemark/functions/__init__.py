"""Column expressions. All of them run in the JVM; there is no Python UDF here."""
