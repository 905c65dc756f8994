"""Readers, writers and the driver's tables in this package's shapes."""
