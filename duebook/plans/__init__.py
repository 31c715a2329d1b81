"""Billing transforms, from source tables to the open item and balance list."""
