"""DataFrame-in, DataFrame-out operators on panels and dimensions."""
