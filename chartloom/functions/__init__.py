"""Column expressions: text, numbers and dates. Everything here stays in the JVM."""
