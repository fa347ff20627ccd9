"""Building blocks shared by the operators: per-group positions, column
helpers, the result contract and the lineage cut."""
