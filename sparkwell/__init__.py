"""sparkwell: analytics operators, sources and business queries on PySpark."""
