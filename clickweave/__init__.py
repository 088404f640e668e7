"""Click-log analytics and candidate retrieval as PySpark DataFrame operators."""
