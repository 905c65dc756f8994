"""Column functions. Each takes and returns ``Column`` and runs inside the JVM."""
