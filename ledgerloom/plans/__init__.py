"""Whole plans: the refined tables and the named questions over them."""
