"""DataFrame -> DataFrame operators: projections, joins, aggregates, extraction."""
