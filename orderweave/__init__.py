"""Order and inventory event analytics on PySpark."""
