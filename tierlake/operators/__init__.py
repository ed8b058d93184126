"""DataFrame -> DataFrame operators. None of them knows about layers, batches or monitoring."""
