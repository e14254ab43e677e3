"""Composed dataflows: staging, marts, reports, rotation, documents, indexing, retrieval."""
