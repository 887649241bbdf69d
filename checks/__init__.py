"""Queries over the supplied tables with their SQL counterparts, and the comparison of both."""
