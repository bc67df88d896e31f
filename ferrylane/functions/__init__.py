"""Column-level building blocks: predicates, types and names."""
