"""Column expressions (no DataFrame state): text cleaning, parsing, keys, bins, geometry."""
