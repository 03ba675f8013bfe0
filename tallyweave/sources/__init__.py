"""Feeds: contracts, scans, validation and typing."""
