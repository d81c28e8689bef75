"""Tabloom: prepare, profile, split, model and evaluate large labelled event tables on Spark."""

__version__ = "0.1.0"
