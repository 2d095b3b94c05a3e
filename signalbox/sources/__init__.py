"""Readers: driver tables, captured JSON / XML / HTML documents, CSV, JDBC."""
