"""Queries over the driver's test tables, and the same results in DuckDB SQL."""
