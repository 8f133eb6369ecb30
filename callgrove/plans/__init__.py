"""Building blocks that shape physical plans: lineage cuts, lookups, numbering."""
