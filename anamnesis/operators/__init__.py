"""DataFrame operators: state, joins, ranking, evaluation, annotation, models."""
