"""Failures, by what to do about them."""

from __future__ import annotations


class ConversionError(Exception):
    """Any failure that the engine names."""

    disposition = "fail"


class ReaderUnavailable(ConversionError):
    """The reading service can't be reached: try again, without a limit."""

    disposition = "retry"


class ReaderResponse(ConversionError):
    """The reading service answered nonsense: try again a few times."""

    disposition = "retry_capped"


class BadInput(ConversionError):
    """The document can't be opened or rendered: never try again."""

    disposition = "fail"
