"""Compositions: the staged transform, the star load, reports and the registered queries."""
