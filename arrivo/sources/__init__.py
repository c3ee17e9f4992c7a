"""Sources: the column-contract CSV scan, the dimension CSV, and the
driver's Parquet tables mapped to the trip shape."""
