"""Registered queries over the driver tables, their DuckDB oracles and input derivations."""
