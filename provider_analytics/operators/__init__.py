"""DataFrame operators: subset, geography, enrichment, marts, quality, sinks."""
