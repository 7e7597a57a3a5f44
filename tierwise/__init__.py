"""Layered warehouse analytics as plain PySpark DataFrame functions."""
