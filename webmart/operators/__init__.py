"""DataFrame-to-DataFrame steps of the mart."""
