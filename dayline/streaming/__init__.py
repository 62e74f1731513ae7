"""The increments as micro-batches."""
