"""Readers for recordings, terrain, manifests and pose arrays."""
