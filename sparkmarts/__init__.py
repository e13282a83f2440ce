"""Product, benchmark and clickstream marts as PySpark DataFrame operators."""
