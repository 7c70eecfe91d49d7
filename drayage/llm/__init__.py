"""Text operators for building training corpora."""
