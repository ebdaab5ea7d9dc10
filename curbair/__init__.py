"""Trip and sensor analytics as Spark DataFrame operators."""

from curbair.session import build_session, pin_session

__all__ = ["build_session", "pin_session"]
