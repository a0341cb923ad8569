"""DataFrame-to-DataFrame steps: clean, group, count, generate, filter."""
