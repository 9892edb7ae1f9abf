"""Readers and writers: bronze CSV, versioned layers, serving tables, models."""
