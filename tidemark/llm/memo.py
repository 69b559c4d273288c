"""What a worker remembers between rows, within a fixed number of bytes."""

from __future__ import annotations

from collections.abc import Iterable
from itertools import chain

# Both generations together.
MEMO_BYTES = 64 << 20
# Longer keys are hardly met again.
KEY_BYTES = 64
# About what the two objects and their place in the table take besides their content.
ENTRY_BYTES = 160


class Memo:
    """Results by piece of text, in two generations; what was not asked for lately is forgotten.

    ``known`` holds the results of all pieces last asked for.  Both generations
    together stay within ``limit`` bytes, but for the pieces of the current
    batch.
    """

    def __init__(self, limit: int = MEMO_BYTES) -> None:
        self.limit = limit
        self.known: dict[str | bytes, int | bytes] = {}
        self._older: dict[str | bytes, int | bytes] = {}
        self._long: list[str | bytes] = []
        self._held = 0

    def unseen(self, pieces: Iterable[str | bytes]) -> list[str | bytes]:
        """The pieces whose results must be worked out and given to ``add``."""
        for piece in self._long:
            if (result := self.known.pop(piece, None)) is not None:
                self._held -= ENTRY_BYTES + len(piece) + (len(result) if isinstance(result, bytes) else 0)
        self._long = []
        if self._held > self.limit // 2:
            self.known, self._older, self._held = {}, self.known, 0
        new = set(pieces).difference(self.known)
        if self._older:
            again = list(new.intersection(self._older))
            self.add(again, list(map(self._older.__getitem__, again)))
            new.difference_update(again)
        return list(new)

    def add(self, pieces: list[str | bytes], results: list[int | bytes]) -> None:
        self.known.update(zip(pieces, results))
        size = sum(map(len, pieces))
        if size > KEY_BYTES:
            self._long += [p for p in pieces if len(p) > KEY_BYTES]
        self._held += ENTRY_BYTES * len(pieces) + size
        if results and isinstance(results[0], bytes):
            self._held += sum(map(len, results))

    def clear(self) -> None:
        self.known, self._older, self._long, self._held = {}, {}, [], 0

    def __len__(self) -> int:
        return sum(1 for _ in chain(self.known, self._older))
