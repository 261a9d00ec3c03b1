"""Layer wiring, and the query catalogue with its SQL oracle."""
