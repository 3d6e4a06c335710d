"""Column functions: no I/O, no shuffles, everything stays inside the JVM."""
