"""Named data jobs built from the operators."""
