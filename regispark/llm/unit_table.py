"""Token ids of many texts at once: units found, looked up and replaced by ids with array operations.

Units are those of ``units.units_of``. A unit of up to ``SHORT`` bytes is three whole numbers; an open-addressing
table of such keys leads to its ids. So a known word costs a few array reads, and only words that were
not met before are encoded one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np

from regispark.llm.units import ODD

SHORT = 24
#: Units a table holds before the ones used least recently go, and its places; some 150 MB when full.
HELD, PLACES = 2_000_000, 1 << 23
#: Bytes of texts that are looked up at once.
AT_ONCE = 4 << 20

_CONTROL = np.zeros(256, bool)
_CONTROL[[0, 9, 11, 12, 13, 28, 29, 30, 31]] = True
_WIDE = np.zeros(256, bool)  # first bytes of white space beyond ASCII
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_ALNUM = np.array([chr(c).isalnum() and c < 128 for c in range(256)])
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ x >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ x >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return x ^ x >> np.uint64(31)


class UnitTable:
    """Encodes texts (bytes of UTF-8) from the ids of their units.

    ``encode_units`` takes units, with the blank or line feed they open with, and returns where the ids of each
    begin, how many there are, and the ids of all; ``encode_whole`` returns the ids of a text that
    cannot be cut at blanks.
    """

    def __init__(
        self,
        encode_units: Callable[[Sequence[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]],
        encode_whole: Callable[[str], np.ndarray],
        held: int = HELD,
    ):
        self.encode_units, self.encode_whole, self.held = encode_units, encode_whole, held
        self.long: dict[bytes, np.ndarray] = {}
        self.round = 0
        self._clear()

    def _clear(self) -> None:
        self.place = np.full(PLACES, -1, np.int32)
        self.keys = np.zeros((0, 3), np.uint64)
        self.first, self.count = np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.used = np.zeros(0, np.int32)
        self.ids = np.zeros(0, np.uint32)

    def encode(self, texts: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after the other, and how many each has."""
        out, sizes = [], []
        lot: list[bytes] = []
        held = 0
        for text in texts:
            if lot and held + len(text) > AT_ONCE:
                self._encode(lot, out, sizes)
                lot, held = [], 0
            lot.append(text)
            held += len(text)
        if lot:
            self._encode(lot, out, sizes)
        return np.concatenate(out or [self.ids[:0]]), np.concatenate(sizes or [np.zeros(0, np.int64)])

    def _encode(self, texts: list[bytes], out: list, sizes: list) -> None:
        self.round += 1
        odd = np.zeros(len(texts), bool)
        data = np.frombuffer(b"".join(texts) + bytes(SHORT), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        end = np.cumsum(size)
        start = end - size
        gap = (data == 32) | (data == 10)
        # A gap between two others is cut at; texts with gaps elsewhere, or other white space, are not cut.
        bad = gap[:-1] & gap[1:] | _CONTROL[data[:-1]]
        bad = np.flatnonzero(bad[: end[-1]])
        full = size > 0
        odd[np.searchsorted(end, bad, side="right")] = True
        odd[full] |= gap[start[full]] | gap[end[full] - 1]
        wide = np.unique(np.searchsorted(end, np.flatnonzero(_WIDE[data[: end[-1]]]), side="right"))
        for k in wide.tolist():
            odd[k] = odd[k] or ODD.search(texts[k].decode()) is not None
        whole = {k: self.encode_whole(texts[k].decode()) for k in np.flatnonzero(odd).tolist()}

        kept = np.flatnonzero(full & ~odd)
        inside = np.zeros(len(data), bool)
        inside[np.flatnonzero(gap)] = True
        inside[start[kept]] = True
        for k in np.flatnonzero(odd).tolist():
            inside[start[k] : end[k]] = False
        inside[end[-1] :] = False
        # Where units end; a full stop or comma after a letter or digit is a unit by itself.
        last = np.zeros(len(data) + 1, bool)
        last[end[kept]] = True
        last[1:-1] |= inside[1:]
        at = np.flatnonzero(last[:-1]) - 1
        at = at[at > 0]
        tail = at[((data[at] == 46) | (data[at] == 44)) & _ALNUM[data[at - 1]]]
        # Not before a text's first byte, and not in a text that is encoded whole.
        owner = np.searchsorted(end, tail, side="right")
        inside[tail[(tail > start[owner]) & ~odd[owner]]] = True
        begin = np.flatnonzero(inside)
        stop = np.r_[begin[1:], end[kept[-1]]] if len(kept) else begin
        owner = np.searchsorted(end, begin, side="right")
        stop = np.minimum(stop, end[owner])
        entry, found = self._entries(data, begin, stop, start[owner] == begin)

        count = np.where(found, self.count[entry], 0).astype(np.int64) if len(entry) else entry
        first = self.first[entry] if len(entry) else entry
        slow = np.flatnonzero(~found)
        extra = [self.long[data[a:b].tobytes()] for a, b in zip(begin[slow].tolist(), stop[slow].tolist())]
        pool = np.concatenate([self.ids, *extra]) if extra else self.ids
        count[slow] = [len(x) for x in extra]
        first[slow] = len(self.ids) + np.cumsum([0, *(len(x) for x in extra[:-1])]) if extra else 0
        total = np.cumsum(count)
        ids = pool[np.repeat(first - (total - count), count) + np.arange(total[-1] if len(total) else 0)]
        per_text = np.bincount(owner, weights=count, minlength=len(texts)).astype(np.int64)
        if whole:
            ids, per_text = self._with_whole(ids, per_text, whole)
        out.append(ids)
        sizes.append(per_text)
        if len(self.keys) > self.held:
            self._shrink()
        if len(self.long) > self.held // 10:
            self.long = {}

    @staticmethod
    def _with_whole(ids: np.ndarray, per_text: np.ndarray, whole: dict) -> tuple[np.ndarray, np.ndarray]:
        parts, at = [], 0
        ends = np.cumsum(per_text)
        per_text = per_text.copy()
        for k, own in whole.items():
            parts += [ids[at : ends[k]], own]
            at = int(ends[k])
            per_text[k] = len(own)
        return np.concatenate([*parts, ids[at:]]), per_text

    def _entries(self, data: np.ndarray, begin: np.ndarray, stop: np.ndarray, opens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Entry of each unit in the table; those not ``found`` are long ones, in ``self.long``."""
        size = stop - begin
        words = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))
        # A unit at a text's start may look like one after a cut, but never like one after a gap.
        key = np.stack(
            [words[np.minimum(begin + 8 * k, len(words) - 1)] & _MASKS[np.clip(size - 8 * k, 0, 8)] for k in range(3)], axis=1
        )
        short = np.flatnonzero(size <= SHORT)
        entry = np.full(len(begin), -1, np.int64)
        entry[short] = self._found(key[short])
        new = short[entry[short] < 0]
        if len(new):
            self._learn(data, begin[new], stop[new], key[new])
            entry[new] = self._found(key[new])
        self.used[entry[short]] = self.round
        unknown = {data[a:b].tobytes() for a, b in zip(begin[size > SHORT].tolist(), stop[size > SHORT].tolist())}
        unknown = [u for u in unknown if u not in self.long]
        if unknown:
            first, count, ids = self.encode_units(unknown)
            self.long.update((u, ids[a : a + n]) for u, a, n in zip(unknown, first.tolist(), count.tolist()))
        return entry, size <= SHORT

    def _hashed(self, key: np.ndarray) -> np.ndarray:
        return _mixed(key[:, 0] + _mixed(key[:, 1] + _mixed(key[:, 2])))

    def _found(self, key: np.ndarray) -> np.ndarray:
        """Entry of each key, -1 where there is none."""
        out = np.full(len(key), -1, np.int64)
        left = np.arange(len(key))
        at = (self._hashed(key) & np.uint64(PLACES - 1)).astype(np.int64)
        while len(left):
            entry = self.place[at]
            there = entry >= 0
            left, at, entry = left[there], at[there], entry[there]
            same = (self.keys[entry] == key[left]).all(axis=1)
            out[left[same]] = entry[same]
            left, at = left[~same], (at[~same] + 1) & (PLACES - 1)
        return out

    def _learn(self, data: np.ndarray, begin: np.ndarray, stop: np.ndarray, key: np.ndarray) -> None:
        _, one = np.unique(self._hashed(key), return_index=True)
        raw = data.tobytes()
        units = [raw[a:b] for a, b in zip(begin[one].tolist(), stop[one].tolist())]
        self._add(key[one], *self.encode_units(units))
        rest = self._found(key) < 0
        if rest.any():  # two keys of one hash
            self._learn(data, begin[rest], stop[rest], key[rest])

    def _add(self, key: np.ndarray, first: np.ndarray, count: np.ndarray, ids: np.ndarray) -> None:
        base = len(self.keys)
        self.keys = np.concatenate([self.keys, key])
        self.first = np.concatenate([self.first, first + len(self.ids)])
        self.count = np.concatenate([self.count, count.astype(np.int32)])
        self.used = np.concatenate([self.used, np.full(len(key), self.round, np.int32)])
        self.ids = np.concatenate([self.ids, ids.astype(np.uint32)])
        entry = np.arange(base, base + len(key))
        at = (self._hashed(key) & np.uint64(PLACES - 1)).astype(np.int64)
        while len(entry):
            free = self.place[at] < 0
            self.place[at[free]] = entry[free]  # of several for one place, one gets it
            open_ = self.place[at] != entry
            entry, at = entry[open_], (at[open_] + 1) & (PLACES - 1)

    def _shrink(self) -> None:
        """Keeps the half that was used last."""
        kept = np.sort(np.argsort(-self.used, kind="stable")[: self.held // 2])
        key, count, used = self.keys[kept], self.count[kept].astype(np.int64), self.used[kept]
        first = np.cumsum(count) - count
        ids = self.ids[np.repeat(self.first[kept] - first, count) + np.arange(count.sum())]
        self._clear()
        self._add(key, first, count, ids)
        self.used = used
