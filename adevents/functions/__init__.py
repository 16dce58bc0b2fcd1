"""Column-level building blocks: typing rules, predicates, aggregates."""
