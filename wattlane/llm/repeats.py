"""Removal of repeated passages by a distributed, common-prefix-aware sort of suffixes.

A byte goes if a string of ``LENGTH`` bytes covers it that also starts in a document with a smaller doc_id.  Not
every suffix has to be sorted: each window of ``LENGTH`` bytes has an *anchor*, the gram of ``GRAM`` bytes in it whose
hash is smallest, and equal windows have equal anchors.  So suffixes are taken at anchors only (about one byte in
14), with the bytes before them for the part of a window that lies to the left.

1. Each block of documents tells which anchor grams it has (hashes, dealt by hash range); a gram that only one
   document of the corpus has goes no further.
2. Each block sorts the suffixes at the remaining anchors, equal ones once, and sends them as front-coded runs: the
   length of the prefix common with the one before, and the rest.  Runs are dealt by range of the suffixes' order,
   whose first word is a hash of the gram, so that ranges are even without sampling and a gram stays together.
3. A range merges its runs word by word, all of them at once: suffixes that share the prefix known so far are compared
   by their next word, and put into order anew only where that differs.  In the merged order equal windows are
   neighbours; the smallest doc_id of each goes back to the blocks.
4. Blocks mark what to remove.

A gram with more than ``HOT`` suffixes in the corpus (a common line with different text around it) takes another way in
steps 2 and 3, as no task should hold them all: blocks deal the windows around its anchors by a hash of the whole
window, each distinct one once with its smallest and largest doc_id, and the smallest of all comes back.

Everything is one query: the texts are shuffled once, and all steps read that shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from wattlane.llm.texts import mix64, text_bytes, utf8

LENGTH, GRAM = 50, 24
REACH = LENGTH - GRAM
#: Bytes of text of a block, and of the text whose anchors fall into a range, on average.
BLOCK_BYTES, RANGE_BYTES = 8 << 20, 4 << 20

#: Suffixes that a gram may have at most to be sorted in one range; places of a gram that a block need not report.
HOT, LIGHT = 1 << 15, 8

_PIECE = 1 << 17
_LATEST = np.iinfo(np.int64).max
_BYTE = mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
#: A suffix as sorted: hash of the gram, the bytes from the anchor on, those before it backwards, both lengths.
_HEAD = 4
_WIDE = _HEAD + LENGTH + REACH + 2
_SAME_GRAM = _HEAD + GRAM
_WORDS = -(-_WIDE // 8)


def _gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of every GRAM bytes (8 + 16)."""
    h, power, width = _BYTE[data], 0xD1342543DE82EF95, 1
    eight = None
    while width < 16:
        h = h[:-width] * np.uint64(power) + h[width:]
        power, width = power * power % (1 << 64), 2 * width
        if width == 8:
            eight, by_eight = h, np.uint64(power)
    return mix64(h[:len(data) - GRAM + 1] * by_eight + eight[16:16 + len(data) - GRAM + 1])


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of all anchors, rising, and 64-bit hashes of their grams; windows lie inside documents."""
    found, grams = [], []
    windows = REACH + 1
    last = -1
    for lo in range(0, max(len(data) - LENGTH + 1, 0), _PIECE):
        piece = data[lo:lo + _PIECE + LENGTH - 1]
        n = len(piece) - LENGTH + 1
        hashes = _gram_hashes(piece)
        low = (hashes & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(hashes), dtype=np.uint64)
        width = 1
        while 2 * width <= windows:
            low = np.minimum(low[:-width], low[width:])
            width *= 2
        low = np.minimum(low[:n], low[windows - width:windows - width + n])
        starts = np.arange(lo, lo + n)
        doc_end = offsets[np.searchsorted(offsets, starts[[0, -1]], side="right")]
        if doc_end[0] != doc_end[1] or doc_end[0] < lo + n - 1 + LENGTH:
            inside = offsets[(offsets > lo) & (offsets < lo + n - 1 + LENGTH)]
            crossing = np.zeros(n + 1, np.int32)
            np.add.at(crossing, np.clip(inside - LENGTH + 1 - lo, 0, n), 1)
            np.add.at(crossing, np.clip(inside - lo, 0, n), -1)
            low = low[np.cumsum(crossing[:n], dtype=np.int32) == 0]
        at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        at = at[np.concatenate([[True], at[1:] != at[:-1]])] if len(at) else at
        # A neighbouring piece may have taken the same anchor.
        at = at[at + lo > last]
        if len(at):
            last = int(at[-1]) + lo
            found.append(at + lo)
            grams.append(hashes[at])
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    return np.concatenate(found), mix64(np.concatenate(grams) + np.uint64(0x632BE59BD9B4E019))


def _window_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of hash of the LENGTH bytes at each start, as two words."""
    out = np.empty((2, len(starts)), np.uint64)
    words = -(-LENGTH // 8)
    for lo in range(0, len(starts), _PIECE):
        at = starts[lo:lo + _PIECE]
        piece = np.zeros((len(at), 8 * words), np.uint8)
        piece[:, :LENGTH] = np.lib.stride_tricks.sliding_window_view(data, LENGTH)[at]
        for which, seed in enumerate((0x243F6A8885A308D3, 0x13198A2E03707344)):
            h = np.full(len(at), seed, np.uint64)
            for word in piece.view(np.uint64).T:
                h = mix64(h ^ word) + np.uint64(seed)
            out[which, lo:lo + len(at)] = h
    return out[0], out[1]


def _equal_runs(first: np.ndarray, second: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by two words, where each distinct pair begins in it, and the number of each row's pair."""
    order = np.lexsort((second, first))
    a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    number = np.empty(len(order), np.int64)
    number[order] = np.cumsum(new) - 1
    return order, np.flatnonzero(new), number


def _range_of(grams: np.ndarray, ranges: int) -> np.ndarray:
    return ((grams >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _cuts(sorted_ranges: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(range, from, to) of each range in a sorted array."""
    if len(sorted_ranges):
        heads = np.concatenate([[0], np.flatnonzero(np.diff(sorted_ranges)) + 1, [len(sorted_ranges)]])
        for lo, hi in zip(heads[:-1], heads[1:], strict=True):
            yield int(sorted_ranges[lo]), int(lo), int(hi)


def sort_suffixes(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of suffixes (rows of bytes), and whether each one in it differs from the one before.

    Behind the first word only suffixes whose known prefix is shared are looked at, and only those of them are put
    into order anew whose next words differ.
    """
    padded = np.zeros((len(rows), 8 * _WORDS), np.uint8)
    padded[:, :_WIDE] = rows
    words = padded.view(">u8")
    word = words[:, 0].astype(np.uint64)
    order = np.argsort(word)
    new = np.ones(len(rows), bool)
    new[1:] = word[order[1:]] != word[order[:-1]]
    for column in range(1, _WORDS):
        tied = ~new
        tied[:-1] |= tied[1:]
        at = np.flatnonzero(tied)
        word = words[order[at], column].astype(np.uint64)
        group = np.cumsum(new[at]) - 1
        differs = np.flatnonzero((word[1:] != word[:-1]) & (group[1:] == group[:-1]))
        if not len(differs):
            continue
        changed = np.zeros(group[-1] + 1, bool)
        changed[group[differs]] = True
        changed = changed[group]
        at, word, group = at[changed], word[changed], group[changed]
        by = np.lexsort((word, group))
        order[at], word = order[at[by]], word[by]
        new[at[1:]] |= word[1:] != word[:-1]
    return order, new


def _common(rows: np.ndarray) -> np.ndarray:
    """Length of the prefix that each row has in common with the one before; 0 for the first."""
    out = np.zeros(len(rows), np.int64)
    for lo in range(1, len(rows), _PIECE):
        piece = rows[lo - 1:lo + _PIECE]
        differ = piece[1:] != piece[:-1]
        out[lo:lo + _PIECE] = np.where(differ.any(axis=1), differ.argmax(axis=1), rows.shape[1])
    return out


class Block:
    """The documents of a block in a fixed order, their bytes and anchors."""

    def __init__(self, table: pa.Table, ranges: int) -> None:
        table = table.combine_chunks()
        order = pc.sort_indices(table, sort_keys=[("key", "ascending"), ("text", "ascending")])
        self.rows = table.take(order).combine_chunks()
        texts = self.rows.column("text")
        self.data, self.offsets = utf8(texts.chunk(0) if texts.num_chunks else pa.array([], pa.string()))
        self.keys = self.rows.column("key").to_numpy()
        self.places, self.grams = anchors(self.data, self.offsets)
        self.doc = np.searchsorted(self.offsets, self.places, side="right") - 1
        self.ranges = ranges

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct grams, rising, the index of each anchor's gram, and whether several documents have it."""
        grams, index = np.unique(self.grams, return_inverse=True)
        low, high = np.full(len(grams), _LATEST), np.full(len(grams), -_LATEST - 1)
        np.minimum.at(low, index, self.keys[self.doc])
        np.maximum.at(high, index, self.keys[self.doc])
        return grams, index, low != high

    def suffixes(self, masks: dict[int, bytes], hot: dict[int, bytes]) -> None:
        """Sort the suffixes at anchors whose gram's bit is set in ``masks`` (by range), and hash the windows around
        those whose gram's bit is set in ``hot`` as well."""
        grams, index, _ = self.distinct()
        on, warm = np.zeros(len(grams), bool), np.zeros(len(grams), bool)
        for k, lo, hi in _cuts(_range_of(grams, self.ranges)):
            for bits, told in ((on, masks), (warm, hot)):
                if k in told:
                    bits[lo:hi] = np.unpackbits(np.frombuffer(told[k], np.uint8), count=hi - lo)
        self.hash_windows((on & warm)[index])
        keep = (on & ~warm)[index]
        at, self.own = self.places[keep], self.doc[keep]
        self.left = np.minimum(at - self.offsets[self.own], REACH)
        self.right = np.minimum(self.offsets[self.own + 1] - at, LENGTH)
        self.at = at
        made = np.empty((len(at), _WIDE), np.uint8)
        made[:, :_HEAD] = (self.grams[keep] >> np.uint64(32)).astype(">u4").view(np.uint8).reshape(-1, _HEAD)
        padded = np.concatenate([np.zeros(REACH, np.uint8), self.data, np.zeros(LENGTH, np.uint8)])
        around = np.lib.stride_tricks.sliding_window_view(padded, REACH + LENGTH)
        for lo in range(0, len(at), _PIECE):
            piece = around[at[lo:lo + _PIECE]]
            made[lo:lo + _PIECE, _HEAD:_HEAD + LENGTH] = piece[:, REACH:]
            made[lo:lo + _PIECE, _HEAD + LENGTH:-2] = piece[:, REACH - 1::-1]
        # Bytes of neighbouring documents count as 0.
        for lengths, full, start in ((self.right, LENGTH, _HEAD), (self.left, REACH, _HEAD + LENGTH)):
            short = np.flatnonzero(lengths < full)
            made[short, start:start + full] *= np.arange(full) < lengths[short, None]
        made[:, -2], made[:, -1] = self.right, self.left + 1  # never 0 at the end
        order, new = sort_suffixes(made)
        first, self.entry = order[new], np.empty(len(order), np.int64)
        self.entry[order] = np.cumsum(new) - 1
        self.matrix = made[first]
        self.entry_range = _range_of(self.grams[keep][first], self.ranges)
        self.low, self.high = np.full(len(first), _LATEST), np.full(len(first), -_LATEST - 1)
        np.minimum.at(self.low, self.entry, self.keys[self.own])
        np.maximum.at(self.high, self.entry, self.keys[self.own])

    def hash_windows(self, chosen: np.ndarray) -> None:
        """The windows that hold a chosen anchor: distinct ones by hash, with their smallest and largest doc_id."""
        at, doc = self.places[chosen], self.doc[chosen]
        delta = np.zeros(len(self.data) + 1 if len(at) else 1, np.int32)
        np.add.at(delta, np.maximum(at - REACH, self.offsets[doc]), 1)
        np.add.at(delta, np.minimum(at, self.offsets[doc + 1] - LENGTH) + 1, -1)
        self.starts = np.flatnonzero(np.cumsum(delta[:-1], dtype=np.int32) > 0)
        self.start_doc = np.searchsorted(self.offsets, self.starts, side="right") - 1
        first, second = _window_hashes(self.data, self.starts)
        order, heads, self.window = _equal_runs(first, second)
        keys = self.keys[self.start_doc[order]]
        self.window_hash = np.stack([first[order][heads], second[order][heads]], axis=1)
        self.window_low, self.window_high = (f.reduceat(keys, heads) if len(heads) else keys for f in (np.minimum, np.maximum))
        self.window_range = _range_of(self.window_hash[:, 0], self.ranges)

    def runs(self) -> Iterator[tuple[int, bytes, bytes, bytes, bytes]]:
        """Per range: common prefix lengths, rests, and the smallest and largest doc_id of each suffix."""
        common = _common(self.matrix).astype(np.uint8)
        for k, lo, hi in _cuts(self.entry_range):
            common[lo] = 0
            rests = self.matrix[lo:hi][np.arange(_WIDE) >= common[lo:hi, None]]
            yield k, common[lo:hi].tobytes(), rests.tobytes(), self.low[lo:hi].tobytes(), self.high[lo:hi].tobytes()
        # Windows have ranges of their own, behind those of suffixes.
        for k, lo, hi in _cuts(self.window_range):
            yield (self.ranges + k, self.window_hash[lo:hi].astype("<u8").tobytes(), b"",
                   self.window_low[lo:hi].tobytes(), self.window_high[lo:hi].tobytes())

    def removed(self, replies: dict[int, bytes]) -> np.ndarray:
        """Which bytes go: the windows around each anchor for which a smaller doc_id came back."""
        delta = np.zeros(len(self.data) + 1, np.int32)
        order = np.argsort(self.entry, kind="stable")
        heads = np.searchsorted(self.entry[order], np.arange(len(self.matrix) + 1))
        starts = {k: lo for k, lo, _ in _cuts(self.entry_range)}
        bodies = [(np.frombuffer(body, _REPLY), starts[k]) for k, body in replies.items() if k in starts]
        every = np.concatenate([np.empty(0, _REPLY), *[told for told, _ in bodies]])
        entries = every["entry"] + np.repeat([lo for _, lo in bodies], [len(told) for told, _ in bodies]).astype(np.int64)
        for lo in range(0, len(every), _PIECE):
            told, entry = every[lo:lo + _PIECE], entries[lo:lo + _PIECE]
            count = heads[entry + 1] - heads[entry]
            line = np.repeat(np.arange(len(told)), count)
            which = order[_spread(heads[entry], count)]
            before = np.minimum(told["to"][line], self.left[which])
            after = np.maximum(told["from"][line].astype(np.int64), LENGTH - self.right[which])
            good = (told["low"][line] < self.keys[self.own[which]]) & (after <= before)
            at = self.at[which][good]
            np.add.at(delta, at - before[good], 1)
            np.add.at(delta, at - after[good] + LENGTH, -1)
        smallest = np.full(len(self.window_hash), _LATEST)
        for k, lo, _ in _cuts(self.window_range):
            if self.ranges + k in replies:
                told = np.frombuffer(replies[self.ranges + k], _WINDOW_REPLY)
                smallest[told["entry"].astype(np.int64) + lo] = told["low"]
        gone = self.starts[smallest[self.window] < self.keys[self.start_doc]]
        delta[gone] += 1
        delta[gone + LENGTH] -= 1
        return np.cumsum(delta[:-1], dtype=np.int32) > 0


#: A reply: the suffix's number in its run, the offsets of the anchor in its windows, the smallest doc_id of those.
_REPLY = np.dtype([("entry", "<u4"), ("from", "u1"), ("to", "u1"), ("low", "<i8")])
#: A reply on a window: its number among those sent, the smallest doc_id that has it.
_WINDOW_REPLY = np.dtype([("entry", "<u4"), ("low", "<i8")])


class Run:
    """A front-coded run, read from its start."""

    def __init__(self, common: bytes, rests: bytes) -> None:
        self.common, self.rests = common, rests
        self.next, self.at, self.key = 0, 0, b""

    def step(self) -> int:
        """Go to the next suffix; the length of the prefix it has in common with the one before, -1 at the end."""
        if self.next == len(self.common):
            return -1
        common = self.common[self.next]
        end = self.at + _WIDE - common
        self.key = self.key[:common] + self.rests[self.at:end]
        self.at = end
        self.next += 1
        return common


def _decoded(common: np.ndarray, rests: np.ndarray) -> np.ndarray:
    """The suffixes of runs one after the other, as rows of bytes; a run begins with a prefix length of 0."""
    rows = np.empty((len(common), _WIDE), np.uint8)
    ends = np.cumsum(_WIDE - common.astype(np.int64))
    places = np.arange(_WIDE)
    step = _PIECE >> 3
    for lo in range(0, len(common), step):
        hi = min(lo + step, len(common))
        begin = int(ends[lo - 1]) if lo else 0
        # Byte p of a suffix is that of the last one up to it that sends it; 0 stands for the row before the piece.
        sent = np.where(places >= common[lo:hi, None], (ends[lo:hi] - begin - _WIDE + 1).astype(np.int32)[:, None] + places.astype(np.int32), 0)
        np.maximum.accumulate(sent, axis=0, out=sent)
        piece = rests[begin:int(ends[hi - 1])]
        rows[lo:hi] = piece[np.maximum(sent, 1) - 1]
        if lo and common[lo]:
            rows[lo:hi] = np.where(sent == 0, rows[lo - 1], rows[lo:hi])
    return rows


#: An anchor's offsets in windows, from and to, and the smallest doc_id that has those windows.
Segment = tuple[int, int, int]


def _segments(contexts: list[bytes], lows: list[int]) -> list[list[Segment]]:
    """For each distinct suffix of a gram, with its left bytes: the smallest doc_id of the windows around it.

    Two suffixes share the window with the anchor at an offset if the bytes before it agree that far and those from
    the anchor on agree to the window's end, so shared offsets are an interval.  This is the plain form, by pairs.
    """
    rights = [int.from_bytes(c[_HEAD:_HEAD + LENGTH]) for c in contexts]
    lefts = [int.from_bytes(c[_HEAD + LENGTH:-2]) for c in contexts]
    first, last = [LENGTH - c[-2] for c in contexts], [c[-1] - 1 for c in contexts]
    smaller: list[list[Segment]] = [[] for _ in contexts]
    for i, low in enumerate(lows):
        right, left = rights[i], lefts[i]
        for j in range(i):
            if lows[j] == low:
                continue
            start = max(((right ^ rights[j]).bit_length() + 7) // 8, first[i], first[j])
            stop = min(REACH - ((left ^ lefts[j]).bit_length() + 7) // 8, last[i], last[j])
            if start <= stop:
                smaller[i if lows[j] < low else j].append((start, stop, min(low, lows[j])))
    out = []
    for low, lo, hi, others in zip(lows, first, last, smaller, strict=True):
        if not others:
            out.append([(lo, hi, low)] if lo <= hi else [])
            continue
        values: list[int | None] = [low] * (hi - lo + 1)
        for start, stop, other in others:
            for at in range(start - lo, stop - lo + 1):
                if other < values[at]:
                    values[at] = other
        out.append(_joined([None] * lo + values))
    return out


def _joined(values: list[int | None]) -> list[Segment]:
    """Neighbouring offsets of equal value as one segment; NULL ones have none."""
    parts: list[Segment] = []
    for offset, value in enumerate(values):
        if value is None:
            continue
        if parts and parts[-1][2] == value and parts[-1][1] == offset - 1:
            parts[-1] = (parts[-1][0], offset, value)
        else:
            parts.append((offset, offset, value))
    return parts


def _segments_of_many(contexts: list[bytes], lows: list[int]) -> list[list[Segment]]:
    """The same, by the windows at each offset."""
    keys = np.frombuffer(b"".join(contexts), np.uint8).reshape(-1, _WIDE)
    smallest, inside = _smallest(keys, np.array(lows, np.int64))
    return [_joined([v if i else None for v, i in zip(*row, strict=True)]) for row in zip(smallest.tolist(), inside.tolist(), strict=True)]


def _smallest(keys: np.ndarray, lows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each distinct suffix, in order: the smallest doc_id of the window with the anchor at each offset, and whether
    that window lies inside the document.

    A window is known by the number of its part from the anchor on among the prefixes of that length, and the
    number of its part before the anchor likewise.
    """
    offsets = np.arange(REACH + 1)
    inside = (keys[:, -2, None] >= LENGTH - offsets) & (keys[:, -1, None] > offsets)
    smallest = np.where(inside, lows[:, None], _LATEST)
    ahead, lefts = _common(keys[:, :_HEAD + LENGTH]), keys[:, _HEAD + LENGTH:-2]
    by_left = np.argsort(np.ascontiguousarray(lefts).view(f"S{REACH}").reshape(-1))
    behind = _common(lefts[by_left])
    left = np.empty(len(keys), np.int64)
    for offset in range(REACH + 1):
        right = np.cumsum(ahead < _HEAD + LENGTH - offset)
        left[by_left] = np.cumsum(behind < offset)
        rows = np.flatnonzero(inside[:, offset] & (np.bincount(right)[right] > 1) & (np.bincount(left)[left] > 1))
        if len(rows):
            window = right[rows] * (len(keys) + 1) + left[rows]
            order = np.argsort(window)
            new = np.ones(len(rows), bool)
            new[1:] = window[order[1:]] != window[order[:-1]]
            smallest[rows[order], offset] = np.minimum.reduceat(lows[rows[order]], np.flatnonzero(new))[np.cumsum(new) - 1]
    return smallest, inside


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... of each, as many as its count."""
    return np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())


def _answers(runs: list[tuple[bytes, bytes, bytes, bytes]]) -> list[bytes]:
    """Replies to each run (prefix lengths, rests, smallest and largest doc_ids), packed."""
    common, rests, low, high = (np.frombuffer(b"".join(parts), kind) for parts, kind in zip(zip(*runs, strict=True), (np.uint8, np.uint8, np.int64, np.int64), strict=True))
    ends = np.cumsum([len(run[0]) for run in runs])
    rows = _decoded(common, rests)
    order, new = sort_suffixes(rows)
    heads = np.flatnonzero(new)
    keys, lows, highs = rows[order[heads]], np.minimum.reduceat(low[order], heads), np.maximum.reduceat(high[order], heads)
    del rows
    grams = np.flatnonzero(_common(keys[:, :_SAME_GRAM]) < _SAME_GRAM)
    sizes = np.diff(np.append(grams, len(keys)))
    told = np.minimum.reduceat(lows, grams) < np.maximum.reduceat(highs, grams)
    alone, several = np.repeat(told & (sizes == 1), sizes), np.flatnonzero(np.repeat(told & (sizes > 1), sizes))
    # Segments: offsets from and to, and the smallest doc_id, of each distinct suffix; a suffix alone has one.
    smallest, _ = _smallest(keys[several], lows[several])
    begins = np.ones(smallest.shape, bool)
    begins[:, 1:] = smallest[:, 1:] != smallest[:, :-1]
    at = np.flatnonzero(begins)
    owner = np.concatenate([np.flatnonzero(alone), several[at // (REACH + 1)]])
    segments = np.empty(len(owner), _REPLY)
    one = len(owner) - len(at)
    segments["from"][:one], segments["to"][:one], segments["low"][:one] = 0, REACH, lows[alone]
    segments["from"][one:], segments["low"][one:] = at % (REACH + 1), smallest.reshape(-1)[at]
    segments["to"][one:] = (np.append(at[1:], smallest.size) - 1) % (REACH + 1)
    by_owner = np.argsort(owner, kind="stable")
    owner, segments = owner[by_owner], segments[by_owner]
    # Each entry of a run gets those of its suffix that a document before its last one has.
    first = np.searchsorted(owner, np.arange(len(keys) + 1))
    which = np.empty(len(order), np.int64)
    which[order] = np.cumsum(new) - 1
    counts = first[which + 1] - first[which]
    entry = np.repeat(np.arange(len(which)), counts)
    lines = segments[_spread(first[which], counts)]
    good = lines["low"] < high[entry]
    entry, lines = entry[good], lines[good]
    lines["entry"] = entry - np.append(0, ends)[np.searchsorted(ends, entry, side="right")]
    cuts = np.searchsorted(entry, np.append(0, ends))
    return [lines[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]


def _window_answers(hashes: list[bytes], low: list[bytes], high: list[bytes]) -> list[bytes]:
    """Replies on the windows of each block, packed."""
    both = np.frombuffer(b"".join(hashes), "<u8").reshape(-1, 2)
    lows, highs = np.frombuffer(b"".join(low), np.int64), np.frombuffer(b"".join(high), np.int64)
    order, heads, number = _equal_runs(both[:, 0], both[:, 1])
    smallest = np.minimum.reduceat(lows[order], heads)[number]
    out, at = [], 0
    for own in low:
        end = at + len(own) // 8
        told = np.flatnonzero(smallest[at:end] < highs[at:end])
        lines = np.empty(len(told), _WINDOW_REPLY)
        lines["entry"], lines["low"] = told, smallest[at:end][told]
        out.append(lines.tobytes())
        at = end
    return out


_PAIR = "range long, block long, common binary, rests binary, low binary, high binary"
_BACK = "block long, range long, kind int, body binary"
_PAIR_SCHEMA = pa.schema([("range", pa.int64()), ("block", pa.int64()), *[(c, pa.binary()) for c in ("common", "rests", "low", "high")]])
_BACK_SCHEMA = pa.schema([("block", pa.int64()), ("range", pa.int64()), ("kind", pa.int32()), ("body", pa.binary())])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(list(c), f.type) for c, f in zip(zip(*rows, strict=True) if rows else [[]] * len(schema), schema, strict=True)], schema=schema)


def _ask(ranges: int) -> Callable[[pa.Table], pa.Table]:
    """Step 1 in a block: hashes of its grams, which of them several of its documents have, and which of them stand
    at LIGHT places or more, with the number of places."""

    def run(table: pa.Table) -> pa.Table:
        block = Block(table, ranges)
        grams, index, several = block.distinct()
        places = np.bincount(index, minlength=len(grams))
        number, rows = table.column("block")[0].as_py(), []
        for k, lo, hi in _cuts(_range_of(grams, ranges)):
            many = np.flatnonzero(places[lo:hi] >= LIGHT)
            rows.append((k, number, grams[lo:hi].astype("<u4").tobytes(), np.packbits(several[lo:hi]).tobytes(),
                         many.astype("<u4").tobytes(), places[lo:hi][many].astype("<u4").tobytes()))
        return _table(rows, _PAIR_SCHEMA)

    return run


def _tell(limit: int) -> Callable[[pa.Table], pa.Table]:
    """Step 1 in a range: for each block, which of its grams several documents of the corpus have (kind 0), and which
    may have more than ``limit`` suffixes in the corpus (kind 2; no row if there are none)."""

    def run(table: pa.Table) -> pa.Table:
        number, blocks = table.column("range")[0].as_py(), table.column("block").to_pylist()
        bodies, many, places = ([np.frombuffer(b, "<u4") for b in table.column(c).to_pylist()] for c in ("common", "low", "high"))
        ends = np.cumsum([len(body) for body in bodies])
        cuts = list(zip(blocks, [0, *ends[:-1].tolist()], ends.tolist(), strict=True))
        several = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=len(x)) for b, x in zip(table.column("rests").to_pylist(), bodies, strict=True)])
        total = np.full(len(several), LIGHT, np.int64)
        total[np.concatenate(many) + np.repeat([lo for _, lo, _ in cuts], [len(which) for which in many])] = np.concatenate(places)
        every = np.concatenate(bodies)
        order = np.argsort(every)
        new = np.ones(len(every), bool)
        new[1:] = every[order[1:]] != every[order[:-1]]
        heads, gram = np.flatnonzero(new), np.empty(len(every), np.int64)
        gram[order] = np.cumsum(new) - 1
        shared = ((np.diff(np.append(heads, len(every))) > 1) | (np.maximum.reduceat(several[order], heads) > 0))[gram]
        hot = (np.add.reduceat(total[order], heads) > limit)[gram]
        rows = [(block, number, 0, np.packbits(shared[lo:hi]).tobytes()) for block, lo, hi in cuts]
        if hot.any():
            rows += [(block, number, 2, np.packbits(hot[lo:hi]).tobytes()) for block, lo, hi in cuts if hot[lo:hi].any()]
        return _table(rows, _BACK_SCHEMA)

    return run


def _bodies(back: pa.Table, kind: int) -> dict[int, bytes]:
    told = back.filter(pc.equal(back.column("kind"), kind))
    return dict(zip(told.column("range").to_pylist(), told.column("body").to_pylist(), strict=True))


def _send(ranges: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Step 2: the sorted, front-coded runs of a block."""

    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _table([], _PAIR_SCHEMA)
        block = Block(table, ranges)
        block.suffixes(_bodies(back, 0), _bodies(back, 2))
        number = table.column("block")[0].as_py()
        return _table([(k, number, *parts) for k, *parts in block.runs()], _PAIR_SCHEMA)

    return run


def _merge(ranges: int) -> Callable[[pa.Table], pa.Table]:
    """Step 3: replies of a range to the blocks."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        columns = {c: table.column(c).to_pylist() for c in ("block", "common", "rests", "low", "high")}
        number = table.column("range")[0].as_py()
        if number >= ranges:
            answers = _window_answers(columns["common"], columns["low"], columns["high"])
        else:
            answers = _answers(list(zip(*(columns[c] for c in ("common", "rests", "low", "high")), strict=True)))
        return _table([(block, number, 1, body) for block, body in zip(columns["block"], answers, strict=True) if body], _BACK_SCHEMA)

    return run


_RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start: bigint, end: bigint>>"
_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
_RESULT_SCHEMA = pa.schema([*[(c, pa.int64()) for c in ("doc_id", "n_bytes", "n_removed", "n_spans")], ("kept_sha256", pa.string()), ("spans", _SPANS)])


def _apply(ranges: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Step 4: the result rows of a block."""

    def run(table: pa.Table, back: pa.Table) -> pa.Table:
        if not table.num_rows:
            return _RESULT_SCHEMA.empty_table()
        block = Block(table, ranges)
        block.suffixes(_bodies(back, 0), _bodies(back, 2))
        gone, bounds = block.removed(_bodies(back, 1)), block.offsets
        # Removed runs end where documents do.
        edge = np.ones(len(gone) + 1, bool)
        edge[1:-1] = gone[1:] != gone[:-1]
        edge[bounds] = True
        edges = np.flatnonzero(edge)
        starts, ends = edges[:-1][gone[edges[:-1]]], edges[1:][gone[edges[:-1]]]
        runs = np.searchsorted(starts, bounds)
        sums = np.append(0, np.cumsum(ends - starts))[runs]
        hashes, whole = [], memoryview(block.data)
        for lo, hi, a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), runs[:-1].tolist(), runs[1:].tolist(), strict=True):
            made = sha256()
            for start, end in zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True):
                made.update(whole[lo:start])
                lo = end
            made.update(whole[lo:hi])
            hashes.append(made.hexdigest())
        own = np.repeat(bounds[:-1], np.diff(runs))
        spans = pa.StructArray.from_arrays([pa.array(starts - own), pa.array(ends - own)], fields=list(_SPANS.value_type))
        return pa.table([
            block.rows.column("doc_id").combine_chunks(), pa.array(np.diff(bounds)), pa.array(np.diff(sums)), pa.array(np.diff(runs)),
            pa.array(hashes, pa.string()), pa.ListArray.from_arrays(pa.array(runs, pa.int32()), spans),
        ], schema=_RESULT_SCHEMA)

    return run


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs), ``kept_sha256``
    (of the remaining bytes) and ``spans`` (start and end byte of each removed run).

    Whole texts as UTF-8; NULL counts as empty; matches never cross documents.  Rows that share a doc_id don't
    remove each other's bytes; rows with a NULL doc_id count as later than all others.  An empty table gives an
    empty result.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = text_bytes(rows)
    blocks, ranges = max(1, -(-size // BLOCK_BYTES)), max(1, -(-size // RANGE_BYTES))
    dealt = rows.withColumn("key", F.coalesce("doc_id", F.lit(int(_LATEST)))).withColumn(
        "block", F.pmod(F.xxhash64("key", "text"), F.lit(blocks)))
    by_block = dealt.groupBy("block")
    asked = by_block.applyInArrow(_ask(ranges), _PAIR)
    told = asked.groupBy("range").applyInArrow(_tell(HOT), _BACK)
    sent = by_block.cogroup(told.groupBy("block")).applyInArrow(_send(ranges), _PAIR)
    merged = sent.groupBy("range").applyInArrow(_merge(ranges), _BACK)
    return by_block.cogroup(told.unionByName(merged).groupBy("block")).applyInArrow(_apply(ranges), _RESULT)
