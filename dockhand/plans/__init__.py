"""Composed plans and the bindings of the test tables."""
