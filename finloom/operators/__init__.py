"""Integrity and conformance checks, star joins, roll-ups and the table writer."""
