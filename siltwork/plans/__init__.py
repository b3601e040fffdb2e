"""Whole jobs and multi-step transforms built from the operators."""
