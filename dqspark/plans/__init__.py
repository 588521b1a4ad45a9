"""Jobs a user calls: the warehouse build, its rule lists, monitoring queries."""
