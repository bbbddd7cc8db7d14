"""Whole plans: resolution estimates, the image pipeline, tuning."""
