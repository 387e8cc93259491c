"""Relational building blocks: DataFrame(s) in, DataFrame out."""
