"""Whole jobs: ingest, model build, publishing, upkeep."""
