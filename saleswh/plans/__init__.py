"""Warehouse plans: staging, dimensions, facts, marts, DQ, analytics, governance."""
