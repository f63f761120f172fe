"""Column-level expressions shared by batch and streaming."""
