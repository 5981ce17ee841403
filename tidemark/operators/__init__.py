"""DataFrame operators: parse, constraints, claims, stock, merge, publish, dead letters, metrics, log lines."""
