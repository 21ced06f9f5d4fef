"""Column expressions: everything here returns a ``Column`` and stays JVM-side."""
