"""DataFrame operators: filters, dedup, merges, joins, aggregates, top-k, graph, mining."""
