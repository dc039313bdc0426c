"""Composed plans: the named exports and the read-side views."""
