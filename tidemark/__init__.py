"""Batch ingestion and reconciliation of tables, documents and file drops on Spark."""
