"""Layered analytics jobs (raw, conformed, mart) written as plain PySpark DataFrame transformations."""
