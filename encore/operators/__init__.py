"""DataFrame operators (reshape, aggregate, features, geography, splits, adjustments, evaluation)."""
