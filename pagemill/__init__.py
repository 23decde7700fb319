"""pagemill: document-retrieval analytics and data preparation on PySpark."""
