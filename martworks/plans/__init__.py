"""Data marts: compositions of the operators."""
