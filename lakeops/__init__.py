"""Layered lakehouse operators as plain DataFrame functions for PySpark."""
