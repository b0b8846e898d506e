"""DataFrame operators: series, windows, storms, overflows, areas, grids, statistics."""
