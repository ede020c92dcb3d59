"""Inputs: source/ref scans (``relations``) and CSV seeds (``seeds``)."""
