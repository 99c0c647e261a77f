"""Cutting texts where the vocabularies' patterns always cut, so each distinct piece is encoded once.

The patterns separate letters from other signs and never reach across white space, apart from one
blank before a run and the English contractions. So a run of Latin letters before a plain sign and a
run of plain signs before a letter stand alone, with their blank. What is left between white space
stays whole.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

#: White space of the vocabularies' patterns; Python's own adds four control characters.
SPACE = (r"\t-\r \x85\xa0  -     　")
_LETTER = r"A-Za-zÀ-ÖØ-öø-ɏ"
_SIGN = r".,!?;:\"()|#$%&*"
PIECE = re.compile(
    f" ?[{_LETTER}]+(?=[{_SIGN}{SPACE}]|\\Z)| ?[{_SIGN}]+(?=[{_LETTER}{SPACE}]|\\Z)"
    f"| ?[^{SPACE}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")
#: Stands alone under the vocabularies' patterns: one run of letters with its blank.
LETTERS = re.compile(f" ?[{_LETTER}]+")
KEPT = 200_000  # pieces of a generation
KEPT_CHARS = 48
PART_CHARS = 1 << 20  # characters cut into pieces at once
PART_PIECES = 200_000  # pieces of one long text held at once


class Generations:
    """Encoded pieces by text, made per task. ``encode`` gives the ids of new pieces as
    little-endian bytes; all new pieces of a batch are encoded in one call.

    Two generations: when the young one is full it becomes the old one, and pieces met again move
    up from there. So frequent pieces stay while rare ones go, and at most ``2 * KEPT`` are held,
    none of them over ``KEPT_CHARS``.
    """

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.young, self.old = encode, {}, {}
        self.long: dict[str, bytes] = {}

    def learn(self, pieces: set[str]) -> None:
        """Make the ids of ``pieces`` known until the next call."""
        self.long = {}
        if len(self.young) > KEPT:
            self.young, self.old = {}, self.young
        new = []
        for piece in pieces.difference(self.young):
            found = self.old.get(piece)
            if found is None:
                new.append(piece)
            else:
                self.young[piece] = found
        for piece, ids in zip(new, self.encode(new) if new else ()):
            (self.young if len(piece) <= KEPT_CHARS else self.long)[piece] = ids

    def take(self, pieces: list[str]) -> bytes:
        """Ids of pieces that the last :meth:`learn` named."""
        if self.long:
            young, long = self.young, self.long
            return b"".join([young[p] if p in young else long[p] for p in pieces])
        return b"".join(map(self.young.__getitem__, pieces))


def parts(pattern, text: str) -> Iterator[list[str]]:
    """The matches of the pattern, a bounded number at a time."""
    if len(text) <= PART_CHARS:
        yield pattern.findall(text)
        return
    found = (m[0] for m in pattern.finditer(text))
    while part := list(islice(found, PART_PIECES)):
        yield part


def _groups(texts: Iterable[str]) -> Iterator[list[str]]:
    """Texts in a row that together hold no more than ``PART_CHARS``, or one longer text."""
    held, chars = [], 0
    for text in texts:
        if held and chars + len(text) > PART_CHARS:
            yield held
            held, chars = [], 0
        held.append(text)
        chars += len(text)
    if held:
        yield held


def encoded(texts: Iterable[str], pattern, known: Generations) -> Iterator[bytes]:
    """Ids of each text from those of its pieces. Texts of a group are cut together, so their new
    pieces are encoded in one call."""
    for group in _groups(texts):
        if len(group) == 1:
            out = []
            for pieces in parts(pattern, group[0]):
                known.learn(set(pieces))
                out.append(known.take(pieces))
            yield b"".join(out)
            continue
        cut = [pattern.findall(text) for text in group]
        known.learn(set().union(*cut))
        yield from [known.take(pieces) for pieces in cut]


def encoded_apart(texts: list[str], pattern, known: Generations, special) -> Iterator[bytes]:
    """As :func:`encoded`; texts in which ``special(text)`` finds ids, not None, have these."""
    apart = [special(text) for text in texts]
    plain = encoded([t for t, found in zip(texts, apart) if found is None], pattern, known)
    for found in apart:
        yield next(plain) if found is None else found


class Remembered:
    """Encoded pieces by text. ``encode`` gives the ids of new pieces as little-endian bytes."""

    def __init__(self, encode: Callable[[list[str]], list[bytes]]):
        self.encode, self.known = encode, {}

    def __call__(self, text: str) -> bytes:
        pieces, known = PIECE.findall(text), self.known
        new = list(set(pieces).difference(known))
        if not new:
            return b"".join(map(known.__getitem__, pieces))
        fresh = dict(zip(new, self.encode(new)))
        if len(known) + len(fresh) > KEPT:
            known = {p: known[p] for p in set(pieces).difference(fresh)}
        known.update(fresh)
        out = b"".join(map(known.__getitem__, pieces))
        for piece in fresh:
            if len(piece) > KEPT_CHARS:
                del known[piece]
        self.known = known
        return out


def valid(text: str | None) -> str:
    """The text as UTF-8 can hold it; null counts as empty."""
    return (text or "").encode("utf-8", "replace").decode()
