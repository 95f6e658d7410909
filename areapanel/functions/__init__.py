"""Column functions: keys, calendar, geometry, scores and text."""
