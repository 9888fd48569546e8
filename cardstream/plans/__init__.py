"""Composite plans: the registered queries and the whole job."""
