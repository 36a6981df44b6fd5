"""Seeded hashing and small column expressions."""
