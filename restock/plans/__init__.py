"""Jobs and the query catalog, composed from operators."""
