"""The queries of ``__spark_entry__``: inputs, Spark side, SQL side."""
