"""Model-bound steps as interfaces, with deterministic stand-ins for offline use.

A ``Stub*`` class is no model: it only has the right shape of input and output.
"""

from __future__ import annotations

import threading
from collections.abc import Sequence
from typing import Protocol

import numpy as np


class EmbeddingProvider(Protocol):
    dimension: int

    def embed(self, texts: Sequence[str]) -> np.ndarray: ...


class ChatProvider(Protocol):
    """One reply per conversation; ``settings`` are the model's own (temperature, max_tokens, json_object)."""

    def reply(self, conversations: Sequence[list[dict[str, str]]], **settings: object) -> list[str]: ...


class Tokenizer(Protocol):
    def encode(self, text: str) -> list[int]: ...


class TextTokenizer(Tokenizer, Protocol):
    """One that also gives the text of tokens."""

    def decode(self, ids: list[int]) -> str: ...


class TokenVectors(Protocol):
    """A vector of unit norm for each token of each text."""

    def vectors(self, texts: Sequence[str]) -> list[np.ndarray]: ...


class TokenScorer(Protocol):
    """A learned metric of pairs."""

    def score(self, predictions: Sequence[str], references: Sequence[str]) -> list[float]: ...


class PageFetcher(Protocol):
    """The page of a URL; raises when it can't be had."""

    def fetch(self, url: str) -> str: ...


class FileFetcher(Protocol):
    """The bytes of a file; raises when they can't be had."""

    def content(self, url: str) -> bytes: ...


class PdfReader(Protocol):
    """Height of each page, and its lines with the distance of each from the top."""

    def pages(self, content: bytes) -> list[tuple[float, list[tuple[float, str]]]]: ...


class StubEmbedder:
    """Hashed word counts with unit norm; a stand-in for an embedding model."""

    def __init__(self, dimension: int = 64):
        self.dimension = dimension

    def embed(self, texts: Sequence[str]) -> np.ndarray:
        import zlib

        out = np.zeros((len(texts), self.dimension), np.float32)
        for i, text in enumerate(texts):
            for word in text.lower().split():
                h = zlib.crc32(word.encode())
                out[i, h % self.dimension] += 1 if h >> 31 else -1
        return out / np.maximum(np.linalg.norm(out, axis=1, keepdims=True), 1e-12).astype(np.float32)


class StubChat:
    """Echoes the last message's first line as a JSON question; a stand-in for a chat model."""

    def reply(self, conversations: Sequence[list[dict[str, str]]], **settings: object) -> list[str]:
        import json

        if not settings.get("json_object"):
            return ["Reply to: " + c[-1]["content"].split("\n")[-1] for c in conversations]
        return [json.dumps({"question": c[-1]["content"].split("\n")[0][:80] + "?"}) for c in conversations]


class StubTokenizer:
    """Characters as their code points; a stand-in for a model's tokenizer."""

    def encode(self, text: str) -> list[int]:
        return list(map(ord, text))

    def decode(self, ids: list[int]) -> str:
        return "".join(map(chr, ids))


class StubVectors:
    """One axis for each distinct word of the pair being compared; a stand-in for a model's token vectors."""

    def vectors(self, texts: Sequence[str]) -> list[np.ndarray]:
        words = [t.split() for t in texts]
        axis = {w: i for i, w in enumerate(dict.fromkeys(w for ws in words for w in ws))}
        return [np.eye(len(axis))[[axis[w] for w in ws]] if ws else np.zeros((0, len(axis))) for ws in words]


class StubScorer:
    """F1 of the sets of words; a stand-in for a learned metric."""

    def score(self, predictions: Sequence[str], references: Sequence[str]) -> list[float]:
        sets = [(set(p.split()), set(r.split())) for p, r in zip(predictions, references)]
        return [2 * len(a & b) / (len(a) + len(b)) if a or b else 0.0 for a, b in sets]


class StubFetcher:
    """Fails as many times as the URL's length modulo seven, then has a page; a stand-in for the network.

    Each thread counts for itself, since rows of one URL may be tried side by side; after ``tries`` failures the next is a first try again.
    """

    def __init__(self, tries: int = 6) -> None:
        self.tries = tries
        self.failed: dict[tuple[int, str], int] = {}

    def fetch(self, url: str) -> str:
        own = threading.get_ident(), url
        seen = self.failed.pop(own, 0)
        if seen < len(url) % 7:
            if seen + 1 < self.tries:
                self.failed[own] = seen + 1
            raise OSError("no answer")
        return f"<html>{url}</html>"

    def content(self, url: str) -> bytes:
        if len(url) % 7 == 6:
            raise OSError("404")
        return url.encode()


class StubPdfReader:
    """UTF-8 text in pages of 50 lines, 15 points apart; a stand-in for a PDF library."""

    def pages(self, content: bytes) -> list[tuple[float, list[tuple[float, str]]]]:
        lines = content.decode().split("\n")
        return [(792.0, [(30.0 + 15 * i, x) for i, x in enumerate(lines[a : a + 50])]) for a in range(0, len(lines), 50)]
