"""Column expressions. Each takes and returns ``Column`` and stays on the JVM side."""
