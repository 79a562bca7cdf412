"""Graph operators: degrees, joins, neighbour aggregation, overlap, PageRank, components, placement."""
