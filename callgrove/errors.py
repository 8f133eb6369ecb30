"""Errors raised by the library."""

from __future__ import annotations


class CallgroveError(Exception):
    """Base of all errors below."""


class UnknownMetricError(CallgroveError, ValueError):
    """No experiment of the collection has the requested metric."""


class UnknownExperimentError(CallgroveError, ValueError):
    """An operand is an experiment that the collection does not have."""


class KeyCheckError(CallgroveError, ValueError):
    """Facts refer to threads that their experiment does not have."""


class TreeError(CallgroveError, ValueError):
    """Parent links of a call tree are dangling or cyclic."""


class SystemMismatchError(CallgroveError, ValueError):
    """Operands of an algebra operation have different locations."""


class ReportError(CallgroveError, ValueError):
    """A strict load met reports that cannot be read.

    ``rejects`` is the data frame of all bad reports with their reasons.
    """

    def __init__(self, message: str, rejects) -> None:
        super().__init__(message)
        self.rejects = rejects
