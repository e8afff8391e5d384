"""The query catalog and the SQL each query is checked against."""
