"""Security-event analytics as PySpark DataFrame operators, for batch tables and streams alike."""
