"""Reading statement files, mappings and stored tables."""
