"""Reusable DataFrame operators; none of them knows a table name."""
