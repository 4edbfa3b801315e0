"""Readers: text directories, GeoJSON, keyed datasets, binary objects, JDBC; test fixtures."""
