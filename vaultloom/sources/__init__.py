"""Feeds, table definitions, CSV reading and writing, and the versioned warehouse."""
