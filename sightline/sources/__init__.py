"""Readers for the file formats of the labelling and evaluation jobs."""
