"""Turning catalog frames and overrides into a plan of tables to copy."""
