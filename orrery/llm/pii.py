"""Personal data by anchor expansion.

An Aho-Corasick automaton finds anchors (at-signs, digits, plus signs, URL
schemes and identifier cues) in one pass over the whole text.  Deterministic
local parsers then expand each anchor to its boundaries and validate it.

Kinds, in the order of the digests: ``email``, ``ip``, ``card``, ``phone`` (the
base kinds, leftmost and non-overlapping per kind, failing matches dropped),
then the added kinds ``account`` (a cued IBAN, social-security or account
number) and ``url`` (a URL that carries user:password).  Spans are code-point
offsets, end exclusive.  Null and empty texts have no spans; rows that repeat are searched each on their own;
other columns of the table are kept by ``redact`` and not carried by ``spans``.
"""

from __future__ import annotations

import hashlib
import re

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from .common import bounded_batches, documents, keyed_text, map_arrow

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "account", "url")

# Cues that announce an identifier, and the schemes looked at.
CUES = ("iban", "ssn", "social security number", "account", "acct", "konto", "compte", "cuenta")
SCHEMES = ("http://", "https://", "ftp://")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
_DOTTED = re.compile(r"[0-9]++(?:\.[0-9]++)*+")
_SPACED = re.compile(r"[0-9](?:[ -]?[0-9])*+")
_DIAL = re.compile(r"[ ().0-9-]+")
_CUED = re.compile(r"(?:[ .:#=-]|no\b|nr\b|number\b|is\b){0,12}([A-Za-z]{2}[0-9]{2}(?: ?[A-Za-z0-9]){11,30}|[0-9](?:[ -]?[0-9]){5,16})(?![A-Za-z0-9])", re.I)
_USERINFO = re.compile(r"[^\s/@:]+:[^\s/@]+@[^\s/]+")


def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    for digit in "0123456789":
        a.add_word(digit, ("digit", 1))
    for scheme in SCHEMES:
        a.add_word(scheme, ("scheme", len(scheme)))
    for cue in CUES:
        for form in {cue, cue.upper(), cue.capitalize()}:
            a.add_word(form, ("cue", len(form)))
    a.make_automaton()
    return a


_ANCHORS = _automaton()


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i & 1:
            d = d * 2 - 9 * (d > 4)
        total += d
    return total % 10 == 0


def iban(value: str) -> bool:
    s = value.replace(" ", "").upper()
    if not 15 <= len(s) <= 34:
        return False
    rest = 0
    for c in s[4:] + s[:4]:
        rest = (rest * (10 if c.isdigit() else 100) + int(c, 36)) % 97
    return rest == 1


def _email(text: str, at: int, floor: int) -> tuple[int, int] | None:
    start = at
    while start > floor and text[start - 1] in _LOCAL:
        start -= 1
    if start == at or not (domain := _DOMAIN.match(text, at + 1)):
        return None
    return start, domain.end()


def _octet(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _ips(text: str, start: int, end: int) -> list[tuple[int, int]]:
    """Of a maximal run of dotted numbers, each four in turn."""
    out, parts = [], text[start:end].split(".")
    for i in range(0, len(parts), 4):
        four = parts[i : i + 4]
        stop = start + sum(map(len, four)) + len(four) - 1
        if len(four) == 4 and all(map(_octet, four)):
            out.append((start, stop))
        start = stop + 1
    return out


def _phone(text: str, plus: int) -> tuple[int, int] | None:
    if not "0" <= text[plus + 1 : plus + 2] <= "9":
        return None
    run = _DIAL.match(text, plus + 2)
    body = run.group().rstrip(" ().-") if run else ""
    digits = 1 + sum("0" <= c <= "9" for c in body)
    return (plus, plus + 2 + len(body)) if len(body) >= 2 and 8 <= digits <= 15 else None


def _account(text: str, cue_end: int) -> tuple[int, int] | None:
    found = _CUED.match(text, cue_end)
    if not found:
        return None
    value = found.group(1)
    if value[0].isalpha():  # the longest prefix that is an IBAN
        for end in range(len(value), 14, -1):
            if value[end - 1] != " " and iban(value[:end]):
                return found.start(1), found.start(1) + end
        return None
    return found.span(1)


def find(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans of each kind, in order of their starts."""
    spans: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    email_end = dotted_end = spaced_end = account_end = 0
    for last, (kind, width) in _ANCHORS.iter(text):
        if kind == "digit":
            if last >= dotted_end:
                dotted_end = _DOTTED.match(text, last).end()
                spans["ip"] += _ips(text, last, dotted_end)
            if last >= spaced_end:
                spaced_end = _SPACED.match(text, last).end()
                if spaced_end - last >= 16:
                    digits = text[last:spaced_end].replace(" ", "").replace("-", "")
                    if 16 <= len(digits) <= 19 and luhn(digits):
                        spans["card"].append((last, spaced_end))
        elif kind == "at":
            if got := _email(text, last, email_end):
                spans["email"].append(got)
                email_end = got[1]
        elif kind == "plus":
            if got := _phone(text, last):
                spans["phone"].append(got)
        elif kind == "cue":
            before = text[last - width : last - width + 1] if last >= width else ""
            if last >= account_end and not before.isalnum() and (got := _account(text, last + 1)):
                spans["account"].append(got)
                account_end = got[1]
        elif got := _USERINFO.match(text, last + 1):
            spans["url"].append((last + 1 - width, got.end()))
    return spans


def written(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k in kinds for a, b in spans[k])


def redacted(text: str) -> str:
    """The text with every span (merged where they overlap) named by its kind."""
    cuts = sorted((a, -b, k) for k, found in find(text).items() for a, b in found)
    if not cuts:
        return text
    out, at = [], 0
    for a, b, kind in cuts:
        if a >= at:
            out += (text[at:a], f"[{kind.upper()}]")
        at = max(at, -b)
    return "".join([*out, text[at:]])


def spans(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, counts of the base kinds, the base digest and all spans."""

    def rows(batch: pa.RecordBatch) -> dict[str, list]:
        found = [find(t.as_py()) for t in batch.column("text")]
        return {
            "doc_id": batch.column("doc_id"),
            **{f"n_{k}": [len(f[k]) for f in found] for k in BASE_KINDS},
            "base_sha256": [hashlib.sha256(written(f, BASE_KINDS).encode()).hexdigest() for f in found],
            "spans": [written(f, KINDS) for f in found],
        }

    return map_arrow(keyed_text(df, key, text), "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string", rows)


def redact(df: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``df`` with personal data in ``text`` named by kind; null stays null."""
    bounded_batches(df.sparkSession)

    def run(batches):
        for batch in batches:
            i = batch.schema.get_field_index(text)
            new = pa.array([None if t is None else redacted(t) for t in batch.column(i).to_pylist()], type=batch.schema.field(i).type)
            yield batch.set_column(i, batch.schema.field(i), new)

    return df.mapInArrow(run, df.schema)


def op3_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans(documents(spark, sf_dir))
