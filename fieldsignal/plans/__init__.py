"""Operators composed into whole flows, and the query catalog."""
