"""Training-data operators: near-duplicate search, filters, mixing, archives and token files."""
