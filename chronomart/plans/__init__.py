"""Whole loads: the versioned table store, the entities and the marts built from them."""
