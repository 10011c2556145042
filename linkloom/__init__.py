"""A record-linkage engine on PySpark."""
