"""Exceptions raised by the library."""

from __future__ import annotations


class SpaceNotFound(LookupError):
    """The named space has not been created."""


class SpaceNotEmpty(RuntimeError):
    """``errorifexists`` met a space that already holds rows."""


class ConcurrentWrite(RuntimeError):
    """Another writer published a version of the space first."""


class SpaceWriteError(RuntimeError):
    """Some rows of a load were not written.

    Raised after the good rows have been committed; ``report`` holds the
    :class:`stowage.operators.batches.WriteReport` of the load.
    """

    def __init__(self, message, report):
        super().__init__(message)
        self.report = report
