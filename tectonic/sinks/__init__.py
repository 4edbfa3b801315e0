"""Writers: Parquet / JSON / binary datasets, catalog tables, JDBC, load metrics."""
