"""DataFrame operators: cleaning, joins, aggregation, dedup, Pareto."""
