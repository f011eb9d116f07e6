"""Readers, writers, decoders and the derived input views."""
