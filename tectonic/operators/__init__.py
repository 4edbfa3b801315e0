"""DataFrame -> DataFrame building blocks: slicing, typing, spatial join, dedup, upsert, quality."""
