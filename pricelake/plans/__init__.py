"""End-to-end jobs composed from operators, and the registry of checked queries."""
