"""Queries over the supplied test tables, with matching SQL for an independent engine."""
