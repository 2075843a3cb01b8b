"""Stored tables, reporting views, dashboard queries and whole-path plans."""
