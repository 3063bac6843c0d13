"""Table operators: joins, spatial candidates, rasterising, quantiles, ranking."""
