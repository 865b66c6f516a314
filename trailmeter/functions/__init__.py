"""Column expressions: labels, keys and small aggregates. All stay inside the JVM."""
