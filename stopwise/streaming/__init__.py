"""Refresh of service dates: recompute and overwrite."""
