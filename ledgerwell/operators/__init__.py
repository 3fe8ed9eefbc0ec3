"""Relational building blocks: bounded joins, top-1 picks, keyword matching, resolution and aggregation."""
