"""Names for helper columns that clash with no column of the caller's."""

from __future__ import annotations

from collections.abc import Iterable


def free_names(taken: Iterable[str], count: int) -> list[str]:
    """``count`` names that no column of ``taken`` has in any case."""
    held = {c.lower() for c in taken}
    out: list[str] = []
    i = 0
    while len(out) < count:
        if f"__{i}" not in held:
            out.append(f"__{i}")
        i += 1
    return out
