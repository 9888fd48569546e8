"""DataFrame -> DataFrame operators: metrics, rules, late split, scoring."""
