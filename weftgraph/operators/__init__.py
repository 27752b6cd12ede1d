"""DataFrame-in, DataFrame-out operators; every one returns a lazy plan."""
