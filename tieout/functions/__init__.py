"""Column-level building blocks: contract predicates, casts, the DQ score."""
