"""DataFrame-to-DataFrame operators: dedup, quarantine, numbering, history merges, checks."""
