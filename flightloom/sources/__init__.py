"""Listings, tables and catalog settings."""
