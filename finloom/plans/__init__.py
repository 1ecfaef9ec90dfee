"""Declared tables, the builder that projects them, and the dataset job."""
