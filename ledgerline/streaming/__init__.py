"""Running aggregates over arriving batches: a batch form and a Structured
Streaming form that must agree."""
