"""The rating stream."""
