"""Data products assembled from the operators."""
