"""Whole flows built from the operators: ingest, train, score, tune."""
