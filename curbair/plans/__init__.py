"""End-to-end runs over files."""
