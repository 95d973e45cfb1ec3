"""Inputs (driver tables, role frames) and outputs (month-partitioned sink)."""
