"""Billing plans, one module per department."""
