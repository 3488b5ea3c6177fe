"""DataFrame operators: networks, spatial joins, thinning, matching, aggregates."""
