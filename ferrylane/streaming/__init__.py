"""The available-now form of the insert-only sync."""
