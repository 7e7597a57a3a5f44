"""Readers, landing and the table store."""
