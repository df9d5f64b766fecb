"""Column expressions. Nothing here reads data; everything stays inside the JVM plan."""
