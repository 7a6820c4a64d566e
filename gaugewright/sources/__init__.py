"""Landed documents, topics, history."""
