"""Retail build: conformed dimensions and facts, business marts, report queries."""
