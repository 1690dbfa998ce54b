"""Readers: relational tables, reseller drops and catalog tables."""
