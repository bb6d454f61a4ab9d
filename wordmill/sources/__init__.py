"""Readers, writers and corpus cleaning."""
