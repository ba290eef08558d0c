"""The overlap-aware chunker's kernel: spans of a cleaned text.

Pieces start at spaces.  A chunk takes as many pieces as fit ``size``; the next
one starts at the earliest piece that repeats at most ``overlap`` characters and leaves
room for one new piece.  A piece of ``size`` characters or more is cut by characters.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

_SPACE = re.compile(" ")


def _grouped(starts: list[int], end: int, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    """Spans over pieces that begin at ``starts``, the last ending at ``end``."""
    ends = [*starts[1:], end]
    first = last = 0
    n = len(starts)
    while first < n:
        last = max(last, first)
        while last + 1 < n and ends[last + 1] - starts[first] <= size:
            last += 1
        yield starts[first], ends[last]
        if last + 1 == n:
            return
        room = ends[last + 1] - starts[last + 1]
        while first <= last and (ends[last] - starts[first] > overlap or ends[last] - starts[first] + room > size):
            first += 1


def spans(text: str, size: int, overlap: int) -> Iterator[tuple[int, int]]:
    if not 0 <= overlap < size:
        raise ValueError("the overlap must be smaller than the size")
    starts = [m.start() for m in _SPACE.finditer(text)]
    if text and text[0] != " ":
        starts.insert(0, 0)
    ends = [*starts[1:], len(text)]
    run: list[int] = []
    for a, b in zip(starts, ends):
        if b - a < size:
            run.append(a)
            continue
        if run:
            yield from _grouped(run, a, size, overlap)
        yield from _grouped(list(range(a, b)), b, size, overlap)
        run = []
    if run:
        yield from _grouped(run, len(text), size, overlap)


def chunks(text: str, size: int = 4096, overlap: int = 500) -> list[str]:
    """Trimmed chunks in order; white space alone makes none."""
    found = (text[a:b].strip() for a, b in spans(text, size, overlap))
    return [x for x in found if x]
