"""What callers hand in, held against what an operator can use."""

from __future__ import annotations

from collections.abc import Iterable


def require(holds: object, otherwise: str) -> None:
    """A ``ValueError`` with the given text unless the condition holds."""
    if not holds:
        raise ValueError(otherwise)


def as_names(given: str | Iterable[str] | None, role: str) -> tuple[str, ...]:
    """A lone name or a collection of names; repeats stay, at least one is needed."""
    names = (given,) if isinstance(given, str) else tuple(given or ())
    require(names, f"no {role} given")
    return names


def one_of(value: str, known: Iterable[str], role: str) -> str:
    """The value if it is among the known ones."""
    choices = tuple(known)
    require(value in choices, f"{role} {value!r} is unknown; known are {', '.join(choices)}")
    return value
