"""Column to Column functions; none needs a Python UDF."""
