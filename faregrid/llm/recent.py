"""A bounded cache for tokenised words."""

from __future__ import annotations

from typing import Any


class Recent:
    """At most about ``2 * size`` entries in two generations.

    When the younger generation is full it becomes the older one, and what the older one
    held is dropped; an entry found in the older generation moves to the younger. So entries
    in use stay, however many others pass through.
    """

    def __init__(self, size: int):
        self.size = size
        self.young: dict = {}
        self.old: dict = {}

    def get(self, key) -> Any:
        found = self.young.get(key)
        if found is None:
            found = self.old.get(key)
            if found is not None:
                self.put(key, found)
        return found

    def put(self, key, value) -> None:
        if len(self.young) >= self.size:
            self.old, self.young = self.young, {}
        self.young[key] = value
