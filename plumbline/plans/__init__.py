"""Plan-level helpers: lineage cuts, task sizing and size-checked broadcasts."""
