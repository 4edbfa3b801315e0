"""Training-data operators: language ID, near-duplicate and substring removal, packing,
tokenisation, embedding operators, quality scoring, exact repeats and chat formatting."""
