"""Errors raised by sources and checks."""


class IngestionError(Exception):
    """The input is missing, unreadable, of an unknown format, or empty."""


class ValidationError(Exception):
    """A table breaks its declared rules; ``errors`` lists one line per rule."""

    def __init__(self, message: str, errors: list[str]):
        super().__init__(message)
        self.errors = errors


class PromotionError(Exception):
    """A run does not reach the promotion gate."""
