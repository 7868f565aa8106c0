"""Registered queries over the generated tables and their SQL twins."""
