"""Panel operators: grid, fill, labels, features, checks, splits, metrics, analysis, export, models."""
