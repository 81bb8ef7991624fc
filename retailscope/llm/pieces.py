"""Cutting texts where a byte-level BPE tokenizer surely cuts too, and caching the pieces' tokens.

A single space between two characters that are not white space always starts a new pre-token: words,
numbers and symbols take one space before them and never one inside. The tokens of a text are therefore
those of its pieces, and pieces repeat: each distinct one is encoded once while a worker remembers it.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable, Iterable

DOUBLE_SPACE = re.compile(r"\s\s")
SAFE_CUT = re.compile(r"(?<=\S) (?=\S)")
MAX_CACHED = 250_000
MAX_CACHED_CHARS = 48
BATCH_BYTES = 1 << 18


def vocabulary_path(name: str) -> str:
    """A vocabulary file as given, or by its name among the public tokenizers installed on this machine."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def cut(text: str) -> list[str]:
    """Pieces without the space that led them; all but the first had one."""
    if DOUBLE_SPACE.search(text):
        return SAFE_CUT.split(text)
    return text.split(" ")


class EncodedOnce(dict):
    """What ``encode`` gives for ``lead`` + piece, encoded when first asked for."""

    def __init__(self, encode: Callable[[str], object], lead: str):
        super().__init__()
        self.encode, self.lead = encode, lead

    def __missing__(self, piece: str):
        value = self.encode(self.lead + piece)
        if len(piece) <= MAX_CACHED_CHARS:
            self[piece] = value
        return value

    def make_room(self) -> None:
        """All old pieces go when space runs out."""
        if len(self) > MAX_CACHED:
            self.clear()


class EncodedInBatches:
    """What ``encode`` gives for each distinct piece, for encoders that take many pieces at once.

    Batches are balanced by bytes. ``known`` holds pieces led by a space, ``first`` others.
    """

    def __init__(self, encode: Callable[[list[str]], Iterable]):
        self.encode, self.known, self.first, self.long = encode, {}, {}, []

    def learn(self, texts: list[list[str]]) -> None:
        """Make the pieces of ``texts`` known; all old pieces go when space runs out."""
        if len(self.known) + len(self.first) > MAX_CACHED:
            self.known, self.first = {}, {}
        led: set[str] = set()
        for pieces in texts:
            led.update(pieces[1:])
        self._encode_into(self.known, " ", led.difference(self.known))
        self._encode_into(self.first, "", {pieces[0] for pieces in texts}.difference(self.first))

    def _encode_into(self, target: dict, lead: str, pieces: set[str]) -> None:
        batch, size = [], 0
        for piece in pieces:
            batch.append(piece)
            size += len(piece) + 1
            if size >= BATCH_BYTES:
                self._encode_batch(target, lead, batch)
                batch, size = [], 0
        self._encode_batch(target, lead, batch)

    def _encode_batch(self, target: dict, lead: str, batch: list[str]) -> None:
        if batch:
            target.update(zip(batch, self.encode([lead + p for p in batch])))
            self.long += [(target, p) for p in batch if len(p) > MAX_CACHED_CHARS]

    def forget_long(self) -> None:
        for target, piece in self.long:
            target.pop(piece, None)
        self.long = []


def groups_by_bytes(texts: list[str], limit: int = 4 << 20) -> Iterable[list[str]]:
    """Consecutive texts in groups of about ``limit`` characters, so that work in hand stays bounded."""
    group, size = [], 0
    for text in texts:
        group.append(text)
        size += len(text)
        if size >= limit:
            yield group
            group, size = [], 0
    if group:
        yield group
