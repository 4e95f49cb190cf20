"""Names for columns in between that no column of a frame has."""

from __future__ import annotations

from collections.abc import Iterable


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """`names`, each lengthened until it differs from all columns, upper and lower case alike."""
    taken = {c.lower() for c in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found
