"""Column functions: text repair, variant access, names, recency, selectors, headers, HTML."""
