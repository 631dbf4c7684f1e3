"""Table and stream operators written with the public PySpark APIs."""
