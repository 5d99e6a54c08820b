"""DataFrame -> DataFrame operators (star, keys, changes, graph, layers,
quality, normalise)."""
