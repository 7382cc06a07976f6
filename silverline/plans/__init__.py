"""Composite stages: landing, raw export, the committed store, batch and repair runs."""
