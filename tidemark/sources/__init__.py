"""Readers, writers, versioned datasets and generated dimensions."""
