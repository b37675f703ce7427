"""Jobs composed of the operators, and the registry of queries."""
