"""Table removal and the page automaton in plain Python, over one document: what the expressions are compared with."""

from __future__ import annotations

import re
from itertools import accumulate

ABSTRACT_START = r"(?:\n|^)Abstract(?:\:|\.)?\s?"
END_MARKERS = (
    r"(?:\n|^)Appendix ?\S*(?:\n|\:)",
    r"(?:\n|^)Acknowledgements\.",
    r"(?:\n|^)Author contributions\.",
    r"(?:\n|^)References\s*\n",
    r"(?:\n|^)\d?\s?(?:Data|Code|Code and data) availability",
)
LIGATURES = (("ﬂ", "fl"), ("ﬁ", "fi"))
SPARSE_LINES = 12

# What a caption looks like, and the word counts that tell lines apart.
CAPTION = re.compile(r"(?:\n|^)(?<!\S)Table \w?\d+\.")
WORD_BREAK = re.compile(" |-|–")
WIDE_HEADER, LONG_IF_WIDE, LONG_IF_NARROW, LONG_AT_FIRST = 15, 9, 7, 8
VERY_LONG, BODY_ENDS, TABLE_STARTS = 20, 3, 3
GIVE_UP_WIDE, GIVE_UP_NARROW = 6, 10
CAPTION_STEP = 5

_ABSTRACT = re.compile(ABSTRACT_START)
_END = re.compile("|".join(END_MARKERS))


def _kinds(lines: list[str]) -> tuple[list[int], str, bool]:
    """Word counts; ``s`` (short), ``l`` (long) or ``-`` (neither) for each line; and whether the header is wide."""
    words = [len(WORD_BREAK.split(x)) for x in lines]
    header = next((n for n in words if n > 1), 0)
    wide = header >= WIDE_HEADER
    long_from = LONG_AT_FIRST if not header else LONG_IF_WIDE if wide else LONG_IF_NARROW
    prose = lambda x, n: wide and n > VERY_LONG and not CAPTION.match(x)
    return words, "".join("s" if n < long_from else "-" if prose(x, n) else "l" for x, n in zip(lines, words)), wide


def _scan(lines: list[str]) -> tuple[list[str], list[str]] | None:
    """Body lines that were held back and the lines after the table; None if this is no table.

    A table starts at its third short line.  Long lines pile up and short ones take one
    off; the table ends where a long line makes three.  A pile too high before the start means prose.
    """
    words, kinds, wide = _kinds(lines)
    shorts = [i for i, k in enumerate(kinds) if k == "s"]
    if len(shorts) < TABLE_STARTS:
        return None
    start = shorts[TABLE_STARTS - 1]
    steps = {"s": -1, "-": 0, "l": 1}
    pile = list(accumulate((steps[k] for k in kinds), lambda height, step: max(0, height + step), initial=0))[1:]
    reaches = lambda height, among: next((i for i in among if kinds[i] == "l" and pile[i] == height), None)
    if reaches(GIVE_UP_WIDE if wide else GIVE_UP_NARROW, range(start)) is not None:
        return None
    end = reaches(BODY_ENDS, range(start, len(lines)))
    table, after = (len(lines), []) if end is None else (end + 1, range(end + 1, len(lines)))
    if any(words[i] > VERY_LONG for i in after):
        held = []
    else:
        held = [lines[i] for i in range(kinds.rfind("s", 0, table) + 1, table) if kinds[i] == "l"]
    return held, [lines[i] for i in after if words[i] <= VERY_LONG]


def remove_tables(text: str, keep_prefix: bool = False) -> str:
    """The page without its tables.

    After a caption that starts no table the search goes on a few characters
    further, and what stood before it is lost unless ``keep_prefix``.
    """
    lost = ""
    while caption := CAPTION.search(text):
        before, from_caption = text[: caption.start()], text[caption.start() :]
        found = _scan(from_caption.split("\n"))
        if found is None:
            if keep_prefix:
                lost += before + from_caption[:CAPTION_STEP]
            text = from_caption[CAPTION_STEP:]
        else:
            held, rest = found
            text = before + "\n" + "\n".join(held) + "\n" + "".join(f"{x}\n" for x in rest)
    return lost + text


def document_text(pages: list[str], keep_prefix: bool = False) -> str:
    """Text from the abstract heading to the first end section, tables and sparse pages left out."""
    parts: list[str] | None = None
    for page in pages:
        if parts is None:
            if heading := _ABSTRACT.search(page):
                parts = [page[heading.end() :]]
            continue
        if page.count("\n") < SPARSE_LINES:
            continue
        stripped = remove_tables(page, keep_prefix) if CAPTION.search(page) else ""
        if stripped:
            parts = ["".join(parts) + stripped + "\n"]
            if end := _END.search(parts[0]):
                parts = [parts[0][: end.start()]]
                break
        elif end := _END.search(page):
            parts.append(page[: end.start()])
            break
        else:
            parts.append(page + "\n")
    text = "".join(parts or [])
    for bad, good in LIGATURES:
        text = text.replace(bad, good)
    return text
