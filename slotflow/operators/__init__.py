"""DataFrame -> DataFrame operators: projections and filters, joins, aggregations, windows,
keyed upsert, sorts and unions."""
