"""Query plans: the registered queries, their SQL oracles, join helpers."""
