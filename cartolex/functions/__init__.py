"""Part of cartolex."""
