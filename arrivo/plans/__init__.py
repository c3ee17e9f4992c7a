"""Plans: the model layer (split, scale, search, score), the end-to-end
flow, and the registered queries with their SQL oracles."""
