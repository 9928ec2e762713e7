"""DataFrame -> DataFrame operators: dedup, spatial joins, filters, entity joins, profiles."""
