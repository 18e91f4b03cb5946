"""Affinity ratings and top-N recommendations as PySpark DataFrame operators."""
