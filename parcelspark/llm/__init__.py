"""Training-data operators: mixing, near and substring dedup, packing, scoring, filters, counts."""
