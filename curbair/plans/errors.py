"""Errors of whole runs."""


class EmptyResult(RuntimeError):
    """A run had nothing to work on, or produced no rows."""
