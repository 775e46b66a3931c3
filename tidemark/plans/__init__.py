"""Compositions: a full load, a delta load, and the two end to end."""
