"""Cross-validation, grid search and random search drivers (each fit is a Spark job)."""
