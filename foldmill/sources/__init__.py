"""Readers and writers of tables, the model registry and the run table."""
