"""Column expressions: time, tiles, geodesy, roads, probabilities, bins."""
