"""Runs the engine on the given tables: roles, registered queries and their SQL twins."""
