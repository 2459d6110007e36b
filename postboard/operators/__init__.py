"""DataFrame operators: matching, ranking, lifecycle, enrichment, monitoring and quality."""
