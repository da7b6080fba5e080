"""DataFrame operators: history summaries, joins, ranking, metrics, explanations, scoring."""
