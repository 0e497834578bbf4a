"""Incremental form of the row-wise cleaning."""
