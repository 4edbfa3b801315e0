"""The pipeline layers assembled from the operators: bronze, silver, gold, end-to-end run."""
