"""Column-level building blocks: naming, casting, hashing, rules, instants."""
