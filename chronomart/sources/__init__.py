"""Readers: envelope files, yearly files, page tables, catalog tables; and record flattening."""
