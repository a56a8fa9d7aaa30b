"""Registered queries and the same queries in SQL for a second engine."""
