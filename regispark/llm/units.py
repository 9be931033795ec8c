"""Cutting texts into units that a byte-level BPE encodes independently of each other, with a cache."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence

#: White space other than blank and line feed, and NUL: such texts are not cut at blanks.
ODD = re.compile("[\0\t\r\x0b\x0c\x1c-\x1f\x85\xa0  -     　]")
#: Units of a generation of a cache; two are kept, so that a worker's memory stays bounded.
CACHED = 500_000
#: Marks that end a match of their own after a letter or digit.
TAILS = ".,"
#: Marks a unit that stands for itself; others have lost a leading blank.
WHOLE = "\x00"


def units_of(text: str) -> list[str] | None:
    """Words of a text, cut before a blank or line feed between two non-blanks.

    No pattern match spans such a place: a blank can only open a match there. Returns None for
    texts with runs of white space, or white space of other kinds, which need the pattern itself.
    """
    if not text:
        return []
    if ODD.search(text):
        return None
    units = text.replace("\n", " \n").split(" ")
    if "" in units or "\n" in units:
        return None
    units[0] = WHOLE + units[0]
    return units


def text_of(unit: str) -> str:
    if unit[0] == "\n":
        return unit
    return unit[1:] if unit[0] == WHOLE else " " + unit


class UnitCache:
    """Encodes texts from the ids of their units, which are kept in two generations.

    When the younger one is full it becomes the older one, and the older one goes; a unit found in the
    older one moves up, so frequent units stay. ``encode_units`` takes units (see ``text_of``) and
    returns their ids, each as little-endian 32-bit bytes; ``encode_odd`` does the same for a whole
    text that cannot be cut at blanks.
    """

    def __init__(
        self,
        encode_units: Callable[[Sequence[str]], Iterable[bytes]],
        encode_odd: Callable[[str], bytes],
        limit: int = CACHED,
    ):
        self.encode_units, self.encode_odd, self.limit = encode_units, encode_odd, limit
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}

    def _learn(self, units: set[str]) -> None:
        """Puts units among the known; a full stop or comma after a letter or digit is encoded by itself."""
        known = self.known
        tailed = [u for u in units if u[-1] in TAILS and u[-2:-1].isalnum()]
        plain = units.difference(tailed)
        plain.update(u[:-1] for u in tailed)
        plain.difference_update(known)
        older = self.older.get
        up = {u: ids for u in plain if (ids := older(u)) is not None}
        known.update(up)
        new = list(plain.difference(up))
        known.update(zip(new, self.encode_units(new)))
        if tailed and not self.tails:
            self.tails.update(zip(TAILS, self.encode_units([WHOLE + c for c in TAILS])))
        known.update((u, known[u[:-1]] + self.tails[u[-1]]) for u in tailed)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        cut = [units_of(text) for text in texts]
        known = self.known
        found = [None if units is None else [*map(known.get, units)] for units in cut]
        short = [k for k, ids in enumerate(found) if ids is not None and None in ids]
        if short:
            self._learn({u for k in short for u, ids in zip(cut[k], found[k]) if ids is None})
            for k in short:
                found[k] = [*map(known.__getitem__, cut[k])]
        if len(known) > self.limit:
            self.known, self.older = {}, known
        return [
            self.encode_odd(text) if ids is None else b"".join(ids)
            for text, ids in zip(texts, found)
        ]
