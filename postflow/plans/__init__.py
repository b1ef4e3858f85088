"""User-level batch jobs."""
