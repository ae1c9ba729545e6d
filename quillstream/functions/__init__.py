"""Column expressions. All of them work on one row, so they run in batch and on streams alike."""
