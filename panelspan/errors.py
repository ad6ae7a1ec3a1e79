"""Errors raised by the checks. All of them are ``ValueError``s."""

from __future__ import annotations


class PanelError(ValueError):
    """A panel or a dimension breaks a rule."""


class MissingColumns(PanelError):
    """An input lacks columns it must have."""


class InvalidRows(PanelError):
    """A raw panel holds rows that cannot be read as observations."""


class DuplicateCells(PanelError):
    """Several observations fall into one cell."""


class ConflictingTopics(PanelError):
    """One series key has more than one topic."""


class InvalidHeaders(PanelError):
    """The distinct values of a column cannot become column names."""
