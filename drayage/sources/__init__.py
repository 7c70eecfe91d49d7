"""Readers: landed bodies to typed rows, and files to tables."""
