"""DataFrame -> DataFrame operators: ingest, word scan, rules, results, reports, rate limiting, ordered aggregates."""
