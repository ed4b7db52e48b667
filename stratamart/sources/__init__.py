"""Readers, input shapes, landing with an audit trail, and the star-schema adapter."""
