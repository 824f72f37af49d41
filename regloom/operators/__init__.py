"""DataFrame operators: parse, map, validate, route, diff, normalise."""
