"""Packing by power-of-two decomposition.

A document's tokens are cut into pieces of binary length, the largest first:
as many of the maximum as fit, then one for each set bit of the rest.  Pieces of
equal length form a bucket; a training batch takes sequences of one bucket, so
no sequence crosses documents, none needs padding and none is cut short.

Null and empty texts hold the end id only.  Rows that repeat are packed
each on their own; ``sequence_id`` is unique over all rows.
"""

from __future__ import annotations

import json
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import documents, keyed_text, map_arrow

MAX_LENGTH, END_ID, BATCH_TOKENS = 2048, 1, 65536
MEMO = 250_000
#: In this range normalisation composes nothing and both sides agree on white space, so a text can be taken word by word.
_BEYOND = re.compile(r"[^\x00-\x1b\x20-\u024f]")
#: The normaliser and the split that word by word encoding holds for.
_NORMALISERS = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_BYTES = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}


class _Letters(dict):
    """The byte level form of each character that was met."""

    def __init__(self, byte_level):
        self.byte_level = byte_level

    def __missing__(self, c: int) -> str:
        self[c] = self.byte_level.pre_tokenize_str(chr(c))[0][0]
        return self[c]


class WordTokenizer:
    """A tokenizer whose pieces never cross white space, with words memoised as the bytes of their ids.

    Texts outside the range that was checked against the library, or with a
    special token's string, go to the library whole; so does every text where the file's
    normaliser or pre-tokenizer is another than the one that words were checked for.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.specials = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.letters = _Letters(self.byte_level)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.pieces = self._split(json.loads(self.tokenizer.to_str()))
        self.letters_stay = self.pieces is not None and self.pieces.pattern == _PIECES
        self.single: dict[str, list[int]] = {}

    @staticmethod
    def _split(settings: dict) -> regex.Pattern | None:
        """The pattern of the pieces within words; None if words can't be taken one by one."""
        normalisers = (settings.get("normalizer") or {}).get("normalizers")
        steps = (settings.get("pre_tokenizer") or {}).get("pretokenizers") or []
        if normalisers != _NORMALISERS or len(steps) != 2 or steps[1] != _BYTES or settings["model"]["type"] != "BPE" or settings["model"].get("dropout"):
            return None
        split = steps[0]
        if (split.get("type"), split.get("behavior"), split.get("invert")) != ("Split", "Removed", True) or "Regex" not in split["pattern"]:
            return None
        pattern = regex.compile(split["pattern"]["Regex"])
        return None if any(pattern.search(f"a{s}b") and pattern.search(f"a{s}b").group() != "a" for s in " \n\t") else pattern

    def _word(self, word: str) -> bytes:
        pieces = (word,) if self.letters_stay and word.isalpha() else self.pieces.findall(word)
        plain = word.isascii() and word.isprintable()
        ids: list[int] = []
        for piece in pieces:
            found = self.single.get(piece)
            if found is None:
                found = [t.id for t in self.model.tokenize(piece if plain else piece.translate(self.letters))]
                if len(piece) == 1:  # marks and digits mostly; the range bounds their number
                    self.single[piece] = found
            ids += found
        return _packed(ids)

    def packed(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if self.pieces is None or _BEYOND.search(text) or any(s in text for s in self.specials):
            return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)
        words = text.lower().split()
        parts = list(map(self.young.get, words))
        if None in parts:
            for i, ids in enumerate(parts):
                if ids is None:
                    word = words[i]
                    ids = self.young.get(word)
                    if ids is None:
                        ids = self.old.get(word)
                        if ids is None:
                            ids = self._word(word)
                        if len(word) <= 64:
                            if len(self.young) >= MEMO:
                                self.old, self.young = self.young, {}
                            self.young[word] = ids
                    parts[i] = ids
        return b"".join(parts)

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), "<u4").tolist()


def _packed(ids: list[int]) -> bytes:
    return struct.pack("<%dI" % len(ids), *ids)


_tokenizers: dict[str, WordTokenizer] = {}


def tokenizer(path: str) -> WordTokenizer:
    if path not in _tokenizers:
        _tokenizers[path] = WordTokenizer(path)
    return _tokenizers[path]


def public_vocabulary(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def cuts(n: int, most: int = MAX_LENGTH) -> list[int]:
    """Lengths of the pieces of ``n`` tokens; ``most`` is a power of two."""
    out = [most] * (n // most)
    rest = n % most
    return out + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def pack(df: DataFrame, path: str, most: int = MAX_LENGTH, end_id: int = END_ID, with_ids: bool = True, key: str = "doc_id", text: str = "text", batch_tokens: int = BATCH_TOKENS) -> DataFrame:
    """One row per piece: its place in the document, its sequence and its ``ids``.

    ``length`` is also the bucket: ``batch_id`` (``bucket:partition:k``) puts
    ``batch_tokens`` of one bucket together at most, counted per input partition, so only
    the last batch of each partition's bucket can be short.  ``sequence_id`` numbers the sequences (one
    piece each, at ``offset`` 0), by input partition and row.  There is no shuffle.
    """
    if most < 1 or most & (most - 1):
        raise ValueError("the maximum length must be a power of two")
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, batch_id string" + ", ids array<int>" * with_ids

    def rows(batch: pa.RecordBatch, filled: Counter) -> dict[str, list]:
        t = tokenizer(path)
        out: dict[str, list] = {k: [] for k in ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "batch_id", "ids")}
        part = TaskContext.get().partitionId()
        for doc_id, value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
            ids = np.frombuffer(t.packed(value.as_py()) + _packed([end_id]), "<u4")
            lengths = cuts(len(ids), most)
            at = 0
            for n in lengths:
                out["start"].append(at)
                out["batch_id"].append(f"{n}:{part}:{filled[n] // max(1, batch_tokens // n)}")
                filled[n] += 1
                out["ids_crc32"].append(zlib.crc32(ids[at : at + n]))
                if with_ids:
                    out["ids"].append(ids[at : at + n].astype("i4"))
                at += n
            out["doc_id"] += [doc_id] * len(lengths)
            out["length"] += lengths
            out["doc_tokens"] += [len(ids)] * len(lengths)
        return out

    pieces = map_arrow(keyed_text(df, key, text), schema, rows, Counter)
    return pieces.withColumn("sequence_id", F.monotonically_increasing_id()).withColumn("offset", F.lit(0).cast("long"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_vocabulary(), with_ids=False)
