"""Queries over the supplied test tables, which stand in for a site."""
