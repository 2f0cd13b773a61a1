"""Whole jobs: the layer stages, runs of them, and the analytic questions over gold."""
