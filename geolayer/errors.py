"""Errors raised for bad arguments, before any job starts."""

from __future__ import annotations

from collections.abc import Iterable


class InputValueError(ValueError):
    """An option outside the offered ones."""

    def __init__(self, name: str, valid: Iterable[object], given: object = None) -> None:
        got = f" (got {given!r})" if given is not None else ""
        super().__init__(f"Bad value for {name}{got}; choose from: {', '.join(map(str, valid))}")


class InputTypeError(TypeError):
    """An argument of the wrong shape or type."""

    def __init__(self, name: str, expected: str, example: str | None = None) -> None:
        hint = f", e.g. {example}" if example else ""
        super().__init__(f"{name} must be {expected}{hint}")


class MissingInputError(ValueError):
    """A needed argument is absent and no default can be found."""


class ServiceError(RuntimeError):
    """A reply table carries an error instead of data."""


class ServiceUnavailableError(RuntimeError):
    """A catalog document cannot be read."""


class ZeroMatchedError(ValueError):
    """A selection asked to match at least one row matched none."""

    def __init__(self, detail: str | None = None) -> None:
        super().__init__("No feature matched" + (f": {detail}" if detail else "."))
