"""Landed exports and published targets."""
