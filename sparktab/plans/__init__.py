"""Plans that need more than one operator: neighbour joins, prefix sums, quantiles, stages."""
