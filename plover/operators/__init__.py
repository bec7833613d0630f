"""User-level jobs, one module per layer."""
