"""DataFrame operators: cohort, features, sampling, metrics, joins, ordering."""
