"""Inputs and outputs: posting lines, driver tables, in-memory rows, the report."""
