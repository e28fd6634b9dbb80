"""Feeds, tables and logs: how rows enter and leave the jobs."""
