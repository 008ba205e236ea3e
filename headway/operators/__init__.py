"""DataFrame -> DataFrame jobs, one module per family of the inventory."""
