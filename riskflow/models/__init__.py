"""Distributed model fitting and scoring."""
