"""Operators for training data: scans, formatting, duplicates, decontamination, models and packing."""
