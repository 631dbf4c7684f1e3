"""Reading and writing tables, and setting malformed rows apart."""
