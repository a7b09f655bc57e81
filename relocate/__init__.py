"""Move partitioned tables between stores with Spark and prove that they arrived."""

from relocate.specs import Layout, Selector, Store, TableSpec, split_selectors

__all__ = ["Layout", "Selector", "Store", "TableSpec", "split_selectors"]
