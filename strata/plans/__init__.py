"""Layer jobs composed from the operators, and their command line."""
