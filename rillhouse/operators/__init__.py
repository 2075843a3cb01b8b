"""DataFrame operators, one module per task."""
