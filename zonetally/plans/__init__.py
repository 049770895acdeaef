"""Test views, registered queries with their SQL, and report tables."""
