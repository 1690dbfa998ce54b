"""DataFrame-to-DataFrame steps: lookups, normalising, union and watermarks."""
