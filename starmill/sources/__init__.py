"""Readers of the raw layer and writers of the warehouse layer."""
