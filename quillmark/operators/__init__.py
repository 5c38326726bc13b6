"""DataFrame operators: counts, joins, prefixes, profiles, vectors, sentiment."""
