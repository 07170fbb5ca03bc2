"""Uploads taken in as they arrive."""
