"""goldleaf: layered sales tables and trip-fare model monitoring as plain Spark DataFrame functions."""
