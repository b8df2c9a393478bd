"""Reusable distributed operators the DataFrame API does not offer directly."""
