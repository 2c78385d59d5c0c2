"""Phrases of two to five words that occur together more often than their parts suggest.

Counts are exact and lossless.  An n-gram of word ids is one number of n * b bits.  A Feistel network permutes these
numbers, so that n-grams spread evenly; the top bits of the permuted number are the quotient, all other bits the
remainder, which is kept whole.  A counting quotient filter holds the sorted numbers of a block of text: a bit per
quotient (occupied or not), a bit per entry (end of its run), packed remainders and counters of as many bytes as they
need.  The permutation can be undone, so a filter gives back the n-grams themselves.

Texts are cut into blocks once.  A block's distinct words go to shards by their hashes; a shard counts words by name,
numbers the frequent ones, and answers each block with their numbers.  Each block then writes a filter of its bigrams
of frequent words, split into shards by the topmost bits; a shard merges the sorted filters of all blocks and returns
a bit per entry to each of them: frequent or not.  Three to five words are counted in the same way where all their
bigrams are frequent, which they must be to be frequent themselves.  So nothing is broadcast, and a hot phrase is one
counter in each block.
Shards grow with the input, and so do the rows from each block to them: a block has at most one per shard, or per
entry if those are fewer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from wattlane.llm.texts import mix64, slices, text_bytes, utf8, word_hashes, word_spans
from wattlane.session import materialize

#: Least count, longest phrase and phrases of a language in the registered query.
LEAST, LONGEST, TOP = 100, 5, 2000
#: Bytes of text in a block; a longer text is a block of its own.
BLOCK_BYTES = 8 << 20
#: Bytes of text whose words or n-grams meet in one shard of a language, on average.
SHARD_BYTES = 24 << 20
ROUNDS = 4

#: Bytes that end a piece, and bytes that separate words in it.  Fixed values of the operator's result.
ENDS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"

_END = np.zeros(256, bool)
_END[list(ENDS)] = True
_WORD = ~_END
_WORD[list(BLANKS)] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


# Permuted n-grams: lists of limbs (arrays of 64-bit numbers, the topmost first).


def limb_widths(bits: int) -> list[int]:
    """Bits of each limb of a number of so many bits: two limbs, or as many as 64-bit limbs are needed."""
    limbs = max(2, -(-bits // 64))
    return [(bits + k) // limbs for k in range(limbs)]


def pack(ids: np.ndarray, bits: int) -> list[np.ndarray]:
    """Limbs of rows of ids (n-grams x words), each id of ``bits`` bits, the first word topmost."""
    rows, words = ids.shape
    widths = limb_widths(words * bits)
    limbs = [np.zeros(rows, np.uint64) for _ in widths]
    floor = 0
    for limb in range(len(widths) - 1, -1, -1):
        for word in range(words):
            shift = (words - 1 - word) * bits - floor
            if -bits < shift < widths[limb]:
                value = ids[:, word].astype(np.uint64)
                limbs[limb] |= value << np.uint64(shift) if shift >= 0 else value >> np.uint64(-shift)
        limbs[limb] &= _mask(widths[limb])
        floor += widths[limb]
    return limbs


def unpack(limbs: list[np.ndarray], words: int, bits: int) -> np.ndarray:
    """The ids that ``pack`` took."""
    widths = limb_widths(words * bits)
    out = np.zeros((len(limbs[0]), words), np.uint64)
    floor = 0
    for limb in range(len(widths) - 1, -1, -1):
        for word in range(words):
            shift = (words - 1 - word) * bits - floor
            if -bits < shift < widths[limb]:
                out[:, word] |= limbs[limb] >> np.uint64(shift) if shift >= 0 else limbs[limb] << np.uint64(-shift)
        floor += widths[limb]
    return (out & _mask(bits)).astype(np.int64)


def _mask(width: int) -> np.uint64:
    return np.uint64((1 << width) - 1)


def permute(limbs: list[np.ndarray], widths: list[int], back: bool = False) -> list[np.ndarray]:
    """A permutation of the numbers of these widths, or its inverse: each round changes one limb by all others."""
    limbs = list(limbs)
    steps = range(ROUNDS * len(limbs))
    for step in reversed(steps) if back else steps:
        at = step % len(limbs)
        mixed = np.full(len(limbs[0]), (step + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
        for k, limb in enumerate(limbs):
            if k != at:
                mixed = mix64(mixed ^ limb)
        limbs[at] = limbs[at] ^ (mixed & _mask(widths[at]))
    return limbs


def ordered(limbs: list[np.ndarray], widths: list[int]) -> np.ndarray:
    """Order of the numbers; sorted runs in a row are merged, not sorted again."""
    if sum(widths) <= 64:
        whole = limbs[0]
        for limb, width in zip(limbs[1:], widths[1:], strict=True):
            whole = whole << np.uint64(width) | limb
        return np.argsort(whole, kind="stable")
    return np.lexsort(limbs[::-1])


def heads(limbs: list[np.ndarray]) -> np.ndarray:
    """Where a new number starts in sorted ones."""
    new = np.ones(len(limbs[0]), bool)
    if len(new):
        new[1:] = np.any([limb[1:] != limb[:-1] for limb in limbs], axis=0)
    return new


# The filter: sorted permuted numbers and their counts as bytes.


def _bits(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bits of each value, in a row."""
    if not width:
        return b""
    all_bits = np.unpackbits(values.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little", count=width)
    return np.packbits(all_bits, bitorder="little").tobytes()


def _unbits(data: np.ndarray, n: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(n, np.uint64)
    bits = np.unpackbits(data, count=n * width, bitorder="little").reshape(n, width)
    wide = np.zeros((n, 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    wide[:, :packed.shape[1]] = packed
    return wide.view("<u8").ravel().astype(np.uint64)


def quotient_bits(n: int, width: int) -> int:
    """Bits of the quotient of a filter of n entries whose topmost limb has ``width`` bits left."""
    return min(width, int(n).bit_length())


def to_filter(limbs: list[np.ndarray], counts: np.ndarray, widths: list[int], shard_bits: int) -> bytes:
    """Bytes of a filter of sorted numbers that share their topmost ``shard_bits`` bits."""
    n, top = len(counts), widths[0] - shard_bits
    q = quotient_bits(n, top)
    low = limbs[0] & _mask(top)
    quotient = (low >> np.uint64(top - q)).astype(np.int64)
    occupied = np.zeros(1 << q, np.uint64)
    occupied[quotient] = 1
    run_end = np.ones(n, np.uint64)
    run_end[:-1] = quotient[1:] != quotient[:-1]
    many = counts > 1
    parts = [_bits(occupied, 1), _bits(run_end, 1), _bits(many.astype(np.uint64), 1), _bits(low, top - q)]
    parts += [_bits(limb, width) for limb, width in zip(limbs[1:], widths[1:], strict=True)]
    # Counters above one: seven bits a byte, first the lowest bytes of all of them, then the next ones of the longer.
    rest = counts[many].astype(np.int64) - 2
    while len(rest):
        more = rest >> 7
        parts.append(((rest & 127) | (more > 0) * 128).astype(np.uint8).tobytes())
        rest = more[more > 0] - 1
    return b"".join(parts)


def from_filter(
    data: bytes, n: int, shard: int, widths: list[int], shard_bits: int,
) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted numbers and counts of a filter."""
    raw, top = np.frombuffer(data, np.uint8), widths[0] - shard_bits
    q = quotient_bits(n, top)
    at = 0

    def take(count: int, width: int) -> np.ndarray:
        nonlocal at
        size = -(-count * width // 8)
        at += size
        return _unbits(raw[at - size:at], count, width)

    occupied, run_end, many = take(1 << q, 1), take(n, 1), take(n, 1).astype(bool)
    run = np.cumsum(run_end) - run_end
    quotient = np.flatnonzero(occupied).astype(np.uint64)[run.astype(np.int64)]
    low = take(n, top - q) | quotient << np.uint64(top - q)
    limbs = [low | np.uint64(shard << top)] + [take(n, width) for width in widths[1:]]
    counts = np.ones(n, np.int64)
    where, shift = np.flatnonzero(many), 0
    counts[where] = 2
    while len(where):
        plane = raw[at:at + len(where)].astype(np.int64)
        at += len(where)
        counts[where] += (plane & 127) << shift
        where, shift = where[plane > 127], shift + 7
        counts[where] += 1 << shift
    return limbs, counts


# Blocks of text.

#: shard -1: the words of a block in order, as packed local numbers (twice the number, plus one where a piece starts).
_LEXICON = "lang string, block long, shard int, n long, words array<string>, counts array<long>, width int, codes binary"


def _names(text: str) -> list[str]:
    return [part.split()[0] for part in text.split(", ")]


def block_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct lower-case words of all texts in order of their hashes, these, the word at each place, and whether it
    starts a piece."""
    data, offsets = utf8(texts)
    data = _LOWER[data]
    starts, ends, firsts = word_spans(data, offsets, _WORD)
    kept = data[_WORD[data]]
    lengths = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
    words = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(lengths), pa.py_buffer(np.ascontiguousarray(kept))])
    coded = words.dictionary_encode()
    new = np.ones(len(starts), bool)
    if len(starts):
        seen = np.cumsum(_END[data], dtype=np.int32)[starts]
        new[1:] = seen[1:] != seen[:-1]
        new[firsts[firsts < len(starts)]] = True
    bytes_, cuts = utf8(coded.dictionary)
    hashes = word_hashes(bytes_, cuts[:-1], cuts[1:])
    order = np.argsort(hashes)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    named = coded.dictionary.cast(pa.large_string()).cast(pa.string()).take(pa.array(order))
    return named, hashes[order], rank[coded.indices.to_numpy(zero_copy_only=False)], new


def _lexicon(spread: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks of one language each: a row per shard with its distinct words, and one with the words in order."""
        block = TaskContext.get().partitionId() << 32
        for batch in batches:
            for rows in slices(batch, 1, BLOCK_BYTES):
                for lang in rows.column(0).unique().to_pylist():
                    words, hashes, codes, new = block_words(rows.filter(pc.equal(rows.column(0), lang)).column(1))
                    if not len(codes):
                        continue
                    counts = np.bincount(codes, minlength=len(words))
                    shards = (hashes >> np.uint64(64 - spread)).astype(np.int64) if spread else np.zeros(len(words), int)
                    cuts = np.flatnonzero(np.diff(shards, prepend=-1))
                    ends = pa.array([*cuts.tolist(), len(words), len(words)], pa.int32())
                    width = int(2 * len(words)).bit_length()
                    size, last = len(cuts) + 1, [None] * len(cuts)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([lang] * size, pa.string()), pa.array([block] * size, pa.int64()),
                        pa.array([*shards[cuts].tolist(), -1], pa.int32()),
                        pa.array([*np.diff([*cuts, len(words)]).tolist(), len(codes)], pa.int64()),
                        pa.ListArray.from_arrays(ends, words),
                        pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64())),
                        pa.array([*last, width], pa.int32()),
                        pa.array([*last, _bits((codes << 1 | new).astype(np.uint64), width)], pa.binary()),
                    ], _names(_LEXICON))
                    block += 1

    return run


_WORDS = "lang string, shard int, word string, rank long, f long, block long, n int, width int, ranks binary"
_WORD_TYPES = [pa.string(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(),
               pa.binary()]


def _merge_words(least: int):
    def run(parts: pa.Table) -> pa.Table:
        """Frequent words of a shard, numbered from 1 by name, and for each block the numbers of its words (else 0)."""
        lang, shard = parts.column("lang")[0].as_py(), parts.column("shard")[0].as_py()
        coded = pc.list_flatten(parts.column("words").combine_chunks()).dictionary_encode()
        counts = pc.list_flatten(parts.column("counts").combine_chunks()).to_numpy(zero_copy_only=False)
        codes = coded.indices.to_numpy(zero_copy_only=False)
        sums = np.zeros(len(coded.dictionary), np.int64)
        np.add.at(sums, codes, counts)
        often = np.flatnonzero(sums >= least)
        names = coded.dictionary.take(pa.array(often)).cast(pa.binary())
        often = often[pc.sort_indices(names).to_numpy()]
        ranks = np.zeros(len(sums), np.int64)
        ranks[often] = np.arange(1, len(often) + 1)
        width = int(len(often)).bit_length()
        rows: list[tuple] = [
            (lang, shard, word, k + 1, f, None, None, None, None) for k, (word, f) in enumerate(zip(
                coded.dictionary.take(pa.array(often)).to_pylist(), sums[often].tolist(), strict=True))]
        sizes = parts.column("n").to_numpy()
        told, ends = ranks[codes].astype(np.uint64), np.cumsum(sizes)
        for block, size, end in zip(parts.column("block").to_pylist(), sizes.tolist(), ends.tolist(), strict=True):
            rows.append((lang, shard, None, None, None, block, size, width, _bits(told[end - size:end], width)))
        return _as_table(rows, _WORDS, _WORD_TYPES)

    return run


_FILTERS = "block long, lang string, m int, shard int, spread int, n int, filter binary"


def _filters(block: int, lang: str, m: int, bits: int, spread: int, grams: np.ndarray) -> Iterator[tuple]:
    """Filter rows of a block's n-grams (rows of ids), by shard."""
    widths = limb_widths(m * bits)
    limbs, _, counts = distinct(grams, m, bits)
    spread = min(spread, widths[0])
    shards = (limbs[0] >> np.uint64(widths[0] - spread)).astype(np.int64) if spread else np.zeros(len(counts), np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(counts)]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        if a < b:
            made = to_filter([limb[a:b] for limb in limbs], counts[a:b], widths, spread)
            yield block, lang, m, int(shards[a]), spread, b - a, made


def distinct(grams: np.ndarray, m: int, bits: int) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Sorted permuted numbers of distinct n-grams, the entry of each given row, and the counts."""
    widths = limb_widths(m * bits)
    plain = pack(grams, bits)
    order = ordered(plain, widths)
    plain = [limb[order] for limb in plain]
    new = heads(plain)
    group = np.cumsum(new) - 1
    counts = np.diff(np.concatenate([np.flatnonzero(new), [len(new)]]))
    limbs = permute([limb[new] for limb in plain], widths)
    again = ordered(limbs, widths)
    rank = np.empty(len(again), np.int64)
    rank[again] = np.arange(len(again))
    entry = np.empty(len(order), np.int64)
    entry[order] = rank[group]
    return [limb[again] for limb in limbs], entry, counts[again]


def _as_table(rows: list[tuple], schema: str, types: list[pa.DataType]) -> pa.Table:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    return pa.table([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=_names(schema))


_FILTER_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]


def _bigrams(bits: int, spread: int):
    def run(codes: pa.Table, known: pa.Table) -> pa.Table:
        """A block's filters of two frequent words, and (m = 0) its runs of frequent words with their links."""
        if not codes.num_rows or not known.num_rows:
            return _as_table([], _FILTERS, _FILTER_TYPES)
        block, lang, n, width, body = (codes.column(c)[0].as_py() for c in ("block", "lang", "n", "width", "codes"))
        ids = []
        for r in known.sort_by("shard").to_pylist():
            ranks = _unbits(np.frombuffer(r["ranks"], np.uint8), r["n"], r["width"]).astype(np.int64)
            ids.append(np.where(ranks > 0, ranks + r["before"], 0))
        order = _unbits(np.frombuffer(body, np.uint8), n, width).astype(np.int64)
        ids, new = np.concatenate(ids)[order >> 1], (order & 1).astype(bool)
        linked = np.zeros(n + 1, bool)  # a place and the one before it form a bigram
        linked[1:-1] = (ids[1:] > 0) & (ids[:-1] > 0) & ~new[1:]
        kept = linked[:-1] | linked[1:]
        ids, linked = ids[kept], linked[:-1][kept]
        at = np.flatnonzero(linked)
        rows = list(_filters(block, lang, 2, bits, spread, np.column_stack([ids[at - 1], ids[at]]))) if len(at) else []
        if rows:
            body = np.packbits(linked).tobytes() + _bits(ids.astype(np.uint64), bits)
            rows.append((block, lang, 0, 0, spread, len(ids), body))
        return _as_table(rows, _FILTERS, _FILTER_TYPES)

    return run


def _longer(bits: int, spread: int, longest: int):
    def run(runs: pa.Table, masks: pa.Table) -> pa.Table:
        """A block's filters of three and more words, all of whose bigrams are frequent."""
        if not runs.num_rows or not masks.num_rows:
            return _as_table([], _FILTERS, _FILTER_TYPES)
        block, lang, n, body = (runs.column(c)[0].as_py() for c in ("block", "lang", "n", "filter"))
        raw = np.frombuffer(body, np.uint8)
        linked = np.unpackbits(raw[:-(-n // 8)], count=n).astype(bool)
        ids = _unbits(raw[-(-n // 8):], n, bits).astype(np.int64)
        at = np.flatnonzero(linked)
        entry = distinct(np.column_stack([ids[at - 1], ids[at]]), 2, bits)[1]
        told = masks.sort_by("shard")
        often = np.concatenate([np.unpackbits(np.frombuffer(mask, np.uint8), count=size)
                                for mask, size in zip(told.column("mask").to_pylist(), told.column("n").to_pylist(),
                                                      strict=True)]).astype(bool)
        good = np.zeros(n, bool)
        good[at] = often[entry]
        rows: list[tuple] = []
        whole = good[1:]  # at k: the words from k to k + m - 2 are linked by frequent bigrams
        for m in range(3, longest + 1):
            whole = whole[:-1] & good[m - 1:]
            first = np.flatnonzero(whole)
            if len(first):
                rows += _filters(block, lang, m, bits, spread, np.column_stack([ids[first + k] for k in range(m)]))
        return _as_table(rows, _FILTERS, _FILTER_TYPES)

    return run


_MERGED = "block long, lang string, m int, shard int, n int, mask binary, ids array<long>, f long"
_MERGED_TYPES = [pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int64()),
                 pa.int64()]


def _merge(bits: int, least: int, answer: bool):
    def run(filters: pa.Table) -> pa.Table:
        """Merge the sorted filters of all blocks: frequent n-grams, and for each filter a bit per entry."""
        lang, m, shard, spread = (filters.column(c)[0].as_py() for c in ("lang", "m", "shard", "spread"))
        widths, sizes = limb_widths(m * bits), filters.column("n").to_pylist()
        opened = [from_filter(data, n, shard, widths, spread)
                  for data, n in zip(filters.column("filter").to_pylist(), sizes, strict=True)]
        limbs = [np.concatenate([o[0][k] for o in opened]) for k in range(len(widths))]
        counts = np.concatenate([o[1] for o in opened])
        order = ordered(limbs, widths)
        limbs = [limb[order] for limb in limbs]
        new = heads(limbs)
        sums = np.add.reduceat(counts[order], np.flatnonzero(new))
        often = sums >= least
        first = np.flatnonzero(new)[often]
        grams = unpack(permute([limb[first] for limb in limbs], widths, back=True), m, bits)
        rows: list[tuple] = [
            (None, lang, m, shard, None, None, ids, f)
            for ids, f in zip(grams.tolist(), sums[often].tolist(), strict=True)]
        if answer:
            flags = np.empty(len(order), bool)
            flags[order] = often[np.cumsum(new) - 1]
            ends = np.cumsum(sizes)
            for block, size, end in zip(filters.column("block").to_pylist(), sizes, ends.tolist(), strict=True):
                rows.append((block, lang, m, shard, size, np.packbits(flags[end - size:end]).tobytes(), None, None))
        return _as_table(rows, _MERGED, _MERGED_TYPES)

    return run


def counted(
    docs: DataFrame, least: int = LEAST, longest: int = LONGEST,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Frequent words (lang, word, id, f), frequent phrases (lang, ids, f; single words too) and words by language."""
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string"))
    spread = (text_bytes(rows) // SHARD_BYTES).bit_length()
    saved = materialize(rows.mapInArrow(_lexicon(spread), _LEXICON), "lexicon")
    totals = saved.where("shard < 0").groupBy("lang").agg(F.sum("n").alias("total"))
    parts = saved.where("shard >= 0").select("lang", "shard", "block", "n", "words", "counts")
    words = materialize(parts.groupBy("lang", "shard").applyInArrow(_merge_words(least), _WORDS), "words")
    # Ids of a language run through its shards; one row per shard is summed up.
    sizes = words.where("block IS NULL").groupBy("lang", "shard").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("lang").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    before = sizes.select("lang", "shard", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("before"))
    vocab = materialize(
        words.where("block IS NULL").join(before, ["lang", "shard"]).select(
            "lang", (F.col("before") + F.col("rank")).alias("id"), "word", "f"), "vocabulary")
    bits = int(vocab.agg(F.max("id")).first()[0] or 1).bit_length()
    known = words.where("block IS NOT NULL").join(before, ["lang", "shard"], "left").select(
        F.col("block").alias("home"), "shard", "n", "width", "ranks", F.coalesce("before", F.lit(0)).alias("before"))
    codes = saved.where("shard < 0").select("block", "lang", "n", "width", "codes")
    pairs = materialize(
        codes.groupBy("block").cogroup(known.groupBy("home")).applyInArrow(_bigrams(bits, spread), _FILTERS), "bigrams")
    by_shard = ["lang", "m", "shard"]
    two = materialize(
        pairs.where("m > 0").groupBy(*by_shard).applyInArrow(_merge(bits, least, longest > 2), _MERGED), "frequent")
    found = two.where("block IS NULL")
    if longest > 2:
        runs = pairs.where("m = 0").select("block", "lang", "n", "filter")
        masks = two.where("block IS NOT NULL").select(F.col("block").alias("home"), "shard", "n", "mask")
        more = runs.groupBy("block").cogroup(masks.groupBy("home")).applyInArrow(
            _longer(bits, spread, longest), _FILTERS)
        found = found.unionByName(
            materialize(more.groupBy(*by_shard).applyInArrow(_merge(bits, least, False), _MERGED), "longer"))
    phrases = vocab.select("lang", F.array("id").alias("ids"), "f").unionByName(found.select("lang", "ids", "f"))
    return vocab, phrases, totals


def _exact_score(a: Column, n: Column, left: Column, right: Column) -> Column:
    """floor(1000 * a * n / (left * right)) in decimals of 38 digits."""
    wide = [c.cast("decimal(17,0)") for c in (a, n, left, right)]
    above = F.lit(1000).cast("decimal(4,0)") * wide[0] * wide[1]
    return F.call_function("div", above, wide[2] * wide[3]).cast("long")


def mine(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP) -> DataFrame:
    """Each language's best phrases: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.

    Words are lower-cased (A to Z) runs without blanks inside pieces that ``ENDS`` cut; a phrase counts wherever it
    stands in one piece, overlaps and repeated rows included.  NULL and empty texts have no words, a NULL language is
    ``und``, doc_id is not used, so NULL and repeated ones change nothing, nor do other columns.  Ties are ordered by
    phrase in byte order.  A language without a frequent phrase has no row; an empty table gives none.
    """
    vocab, phrases, totals = counted(docs, least, longest)
    phrases = materialize(phrases, "phrases")
    size = F.size("ids")
    cuts = phrases.where(size > 1).join(totals, "lang").select(
        "lang", "ids", F.col("f").alias("a"), F.col("total").alias("n"),
        F.explode(F.sequence(F.lit(1), size - 1)).alias("k")).select(
        "*", F.slice("ids", F.lit(1), F.col("k")).alias("left"),
        F.slice("ids", F.col("k") + 1, size - F.col("k")).alias("right"))
    part = phrases.select("lang", "ids", "f")
    scored = (
        cuts.join(part.select("lang", F.col("ids").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(part.select("lang", F.col("ids").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .withColumn("score", _exact_score(F.col("a"), F.col("n"), F.col("l"), F.col("r")))
        .groupBy("lang", "ids")
        .agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("cut"))
        .select("lang", "ids", "cut.*")
    )
    # A longer phrase can't be more frequent than a part of it, so the parts shorter by one word say it all.
    inner = phrases.where(size > 2).select(
        "lang", F.col("f").alias("whole"),
        F.explode(F.array(F.slice("ids", F.lit(1), size - 1), F.slice("ids", F.lit(2), size - 1))).alias("ids"))
    around = inner.groupBy("lang", "ids").agg(F.max("whole").alias("whole"))
    free = scored.join(around, ["lang", "ids"], "left").where("whole IS NULL OR whole < a")
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    first = free.withColumn("_rank", F.rank().over(best)).where(F.col("_rank") <= top)
    named = (
        first.select("*", F.posexplode("ids").alias("_at", "id"))
        .join(vocab.select("lang", "id", "word"), ["lang", "id"])
        .groupBy("lang", "ids")
        .agg(*[F.first(c).alias(c) for c in ("a", "l", "r", "n", "score")],
             F.sort_array(F.collect_list(F.struct("_at", "word"))).alias("_words"))
        .withColumn("phrase", F.array_join(F.col("_words.word"), " "))
    )
    final = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return named.withColumn("rank", F.row_number().over(final).cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")


#: The same by brute force over all n-grams.
SQL = """
WITH pieces AS (
  SELECT lang, words FROM (
    SELECT lang, list_filter(string_split_regex(p, '[ \\t]+'), lambda w: w <> '') AS words FROM (
      SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\\x0A-\\x0D]')) AS p
      FROM documents)) WHERE len(words) > 0),
grams AS (
  SELECT lang, phrase, m, count(*) AS f FROM (
    SELECT lang, m, unnest(list_transform(
      range(1, len(words) - m + 2), lambda i: array_to_string(words[i:i + m - 1], ' '))) AS phrase
    FROM pieces, range(1, 6) AS r(m) WHERE m <= len(words)) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM grams WHERE m = 1 GROUP BY lang),
cand AS (SELECT lang, phrase, string_split(phrase, ' ') AS words, m, f FROM grams WHERE m > 1 AND f >= 100),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, t.n, k, l.f AS l, r.f AS r,
         (1000::HUGEINT * c.f * t.n) // (l.f::HUGEINT * r.f) AS score
  FROM cand AS c JOIN totals AS t USING (lang), range(1, 5) AS s(k)
  JOIN grams AS l ON l.lang = c.lang AND l.phrase = array_to_string(c.words[1:k], ' ')
  JOIN grams AS r ON r.lang = c.lang AND r.phrase = array_to_string(c.words[k + 1:], ' ')
  WHERE k < c.m),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_parts AS (
  SELECT c.lang, array_to_string(c.words[i:i + w - 1], ' ') AS phrase, max(c.f) AS whole
  FROM cand AS c, range(2, 5) AS x(w), range(1, 5) AS y(i) WHERE w < c.m AND i + w - 1 <= c.m GROUP BY ALL)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
       phrase, a, l, r, n, score::BIGINT AS score
FROM best LEFT JOIN inner_parts USING (lang, phrase) WHERE whole IS NULL OR 100 * whole < 100 * a
QUALIFY rank <= 2000
"""
