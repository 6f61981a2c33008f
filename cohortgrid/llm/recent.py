"""A bounded table of recent results, in two generations."""

from __future__ import annotations

from collections.abc import Iterable


class Recent:
    """Holds at most about twice ``limit`` results. When the young
    generation is full it becomes the old one; an old result that is asked
    for again moves back to the young."""

    def __init__(self, limit: int) -> None:
        self.limit = limit
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: Iterable) -> list:
        """Keys without a result; the others are in ``young`` from now on."""
        if len(self.young) > self.limit:
            self.young, self.old = {}, self.young
        young, old, out = self.young, self.old, []
        for key in keys:
            if key not in young:
                value = old.get(key)
                if value is None:
                    out.append(key)
                else:
                    young[key] = value
        return out
