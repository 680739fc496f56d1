"""DataFrame operators: selection, joins, scoring, vectors, sampling, k-means, summary."""
