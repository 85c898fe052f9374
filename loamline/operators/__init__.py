"""DataFrame operators: ordered series, features, quality checks, delayed
labels, metrics, models and side-table joins."""
