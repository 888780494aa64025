"""Composed plans: feature build (A16), workflows (M9/M10), query catalog."""
