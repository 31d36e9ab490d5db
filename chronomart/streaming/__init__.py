"""Loads driven by arriving files instead of by a schedule."""
