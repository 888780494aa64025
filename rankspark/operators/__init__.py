"""DataFrame -> DataFrame operators (labels, features, folds, metrics, EDA, models)."""
