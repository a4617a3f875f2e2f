"""Composite jobs: table adapters, processing and validation runs."""
