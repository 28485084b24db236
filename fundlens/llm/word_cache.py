"""A bounded cache of what a tokenizer gives for single words."""

from __future__ import annotations

from collections.abc import Callable, Collection, Hashable

# What a Python object and its place in a dictionary take beside its own bytes.
_ENTRY_BYTES = 150


class WordCache:
    """Words and their values in two generations, and ``pinned`` ones that always stay.

    A word that is used moves to the young generation; when that holds ``budget``
    bytes it becomes the old one and the former old one is dropped. Frequent words
    are thus never lost, whatever number of rare ones passes by. Each generation may
    exceed the budget by the words of one call.
    """

    def __init__(self, budget: int, pinned: dict | None = None):
        self.budget = budget
        self.pinned = pinned or {}
        self.young, self.old, self.used = dict(self.pinned), {}, 0

    def holding(self, words: set[Hashable], encode: Callable[[list], Collection]) -> dict:
        """A dictionary that holds at least the given words; the unknown ones are encoded in one call."""
        if self.used > self.budget:
            self.old, self.young, self.used = self.young, dict(self.pinned), 0
        missing = words.difference(self.young)
        back = [w for w in missing if w in self.old]
        self.young.update((w, self.old[w]) for w in back)
        unknown = list(missing.difference(back))
        if unknown:
            self.young.update(zip(unknown, encode(unknown)))
        self.used += sum(map(len, missing)) + _ENTRY_BYTES * len(missing)
        return self.young
