"""Lists of different lengths as flat arrays, and a bounded memory of words."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import numpy as np

#: Bytes of words and results that one memory holds, and the longest word it keeps.
MEMORY_BYTES = 160 << 20
LONGEST_KEPT = 256
#: What an entry costs besides its word and numbers.
_ENTRY = 200


def gathered(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The slices ``flat[start : start + size]``, one after another."""
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    shift = np.repeat(starts - (ends - sizes), sizes)
    return flat[shift + np.arange(total)]


class Memory:
    """What words stand for, computed once; emptied when its bytes are used up."""

    def __init__(self, compute: Callable[[Sequence[bytes]], Iterable[Sequence[int]]]):
        self.compute = compute
        self.known: dict[bytes, Sequence[int]] = {}
        self.held = 0

    def look_up(self, words: Sequence[bytes]) -> list[Sequence[int]]:
        found = [self.known.get(w) for w in words]
        new = [k for k, x in enumerate(found) if x is None]
        for k, numbers in zip(new, self.compute([words[k] for k in new])):
            found[k] = numbers
            if len(words[k]) <= LONGEST_KEPT:
                self.known[words[k]] = numbers
                self.held += _ENTRY + len(words[k]) + 8 * len(numbers)
        if self.held > MEMORY_BYTES:
            self.known, self.held = {}, 0
        return found
