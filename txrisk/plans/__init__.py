"""Training and the composite jobs."""
