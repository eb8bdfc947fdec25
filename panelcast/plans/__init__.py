"""Composite plans (dataset build, baselines, training, export) and the query catalog."""
