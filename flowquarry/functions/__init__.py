"""Column functions: addresses, identifiers, times."""
