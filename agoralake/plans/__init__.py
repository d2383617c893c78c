"""Runs over a lake: the layered load, the catalogue, the analytics and the health report."""
