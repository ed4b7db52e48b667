"""Writing, publishing and inspecting catalog tables."""
