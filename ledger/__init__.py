"""PySpark-native batch jobs over commerce ledgers: load, check, route, reconcile, report."""
