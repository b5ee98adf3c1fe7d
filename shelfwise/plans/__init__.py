"""Whole jobs and reports, composed from operators."""
