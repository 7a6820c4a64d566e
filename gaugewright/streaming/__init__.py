"""Continuous consumers."""
