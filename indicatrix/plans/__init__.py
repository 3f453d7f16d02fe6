"""Jobs composed from operators, and the registered queries."""
