"""DataFrame operators: keys, extraction, normalisation, loads, incidents, analytics."""
