"""DataFrame operators: cleaning, missing-value policy, joins, dictionary
encoding, dimension enrichment and feature derivation."""
