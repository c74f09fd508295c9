"""DataFrame operators: counts, notices, offsets, metrics."""
