"""Column-level building blocks (native expressions) and plug-in UDFs."""
