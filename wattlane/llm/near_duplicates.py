"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find grouping.

Texts are sets of word shingles.  An element gets ranks 0, 1, 2, ... in a random permutation of the slots, so
every slot of a signature takes the smallest ``rank + random share``; ranks of one element differ between
slots, which lowers the variance against independent hash functions, and ranks above the largest value that a
signature holds need not be looked at (early stopping: a long text looks at one or two ranks).

Bands of equal slots name candidates.  Equal sets are one candidate from the start, so groups of copies
cost nothing.  Inside a bucket nobody meets everybody: every member meets the bucket's smallest document, its *hub*,
and verified links are grouped.  Where the members of a hub are in several components yet, the other links are
found by a prefix filter: two similar sets share one of their first shingles in any order of the shingles, if
enough of them are taken.  The order puts shingles first that the hub and some other members lack.  Variants of one
text differ in places of their own, so those shingles are rare and few pairs meet; each pair that does is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wattlane.llm.grouping import components
from wattlane.llm.texts import UNSPACED, as_signed, mix64, slices, utf8, word_hashes, word_spans
from wattlane.session import materialize

#: Bands and slots in each: a pair at similarity 0.8 shares no band with probability (1 - 0.8**4)**28 = 4e-7.
BANDS, ROWS = 28, 4
SLOTS = BANDS * ROWS
#: Elements whose permutations are kept at once.
_ELEMENTS = 1 << 17
#: Members up to which a hub's own set orders the shingles; beyond, so many members are drawn for that, and shingles
#: are told apart by how many of them have them.  The choice changes how many pairs are verified, not which links are found.
FEW, DRAWN, LEVELS = 24, 16, (1, 2, 4, 8)
_GOLDEN_INT = 0x9E3779B97F4A7C15
_GOLDEN = np.uint64(_GOLDEN_INT)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed shingles of each document, sorted, and where each document's begin."""
    starts, ends, first = word_spans(data, offsets, UNSPACED)
    words = word_hashes(data, starts, ends)
    total, counts = len(words), np.diff(first)
    rolled = np.zeros(total, np.uint64)
    for step in range(width):
        shifted = words[step:]
        rolled[:len(shifted)] = mix64(rolled[:len(shifted)] + shifted) + np.uint64(step)
    sets = []
    for i, n in enumerate(counts):
        lo = first[i]
        if n >= width:
            sets.append(np.unique(rolled[lo:lo + n - width + 1]))
        elif n:
            whole = np.zeros(1, np.uint64)
            for step in range(n):
                whole = mix64(whole + words[lo + step:lo + step + 1]) + np.uint64(step)
            sets.append(whole + np.uint64(n))
        else:
            sets.append(np.empty(0, np.uint64))
    return np.concatenate([*sets, np.empty(0, np.uint64)]), np.concatenate([[0], np.cumsum([len(s) for s in sets])])


def super_minhash(elements: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures of sets (elements of set i stand from ``first[i]`` to ``first[i + 1]``), one row of ``slots``
    values each; a value is rank << 32 | random share.  Empty sets keep the largest value everywhere."""
    out = np.full((len(first) - 1, slots), np.iinfo(np.uint64).max, np.uint64)
    at = 0
    while at < len(first) - 1:
        stop = max(at + 1, int(np.searchsorted(first, first[at] + _ELEMENTS, side="right")) - 1)
        for lo in range(first[at], max(first[stop], first[at] + 1), _ELEMENTS):
            hi = min(first[stop], lo + _ELEMENTS)
            owner = np.repeat(np.arange(stop - at), np.diff(np.clip(first[at:stop + 1], lo, hi)))
            part = np.full((stop - at, slots), np.iinfo(np.uint64).max, np.uint64)
            _ranks(elements[lo:hi], owner, part)
            np.minimum(out[at:stop], part, out=out[at:stop])
        at = stop
    return out


def _ranks(elements: np.ndarray, owner: np.ndarray, out: np.ndarray) -> None:
    """Go through the ranks until every slot of every set with elements is taken."""
    slots = out.shape[1]
    flat, empty = out.reshape(-1), np.iinfo(np.uint64).max
    order = None
    for rank in range(slots):
        if not len(elements):
            return
        drawn = mix64(elements + np.uint64((rank + 1) * _GOLDEN_INT % (1 << 64)))
        share = drawn & np.uint64(0xFFFFFFFF)
        pick = (rank + (((drawn >> np.uint64(32)) * np.uint64(slots - rank)) >> np.uint64(32))).astype(np.int64)
        if rank == 0:
            slot = pick
        else:
            rows = np.arange(len(elements))
            slot = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[:, rank]
        cell = owner * slots + slot
        free = flat[cell] == empty
        np.minimum.at(flat, cell[free], (np.uint64(rank) << np.uint64(32)) | share[free])
        keep = (out == empty).any(axis=1)[owner]
        if rank == 0:
            elements, owner, pick = elements[keep], owner[keep], pick[keep]
            order = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int64), (len(elements), 1))
            rows = np.arange(len(elements))
            order[rows, pick] = order[:, 0]
        elif not keep.all():
            elements, owner, order = elements[keep], owner[keep], order[keep]


def band_keys(signatures: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key for each band of each signature; the band's number is part of it."""
    cut = signatures.reshape(len(signatures), bands, -1)
    keys = np.tile(np.arange(1, bands + 1, dtype=np.uint64) * _GOLDEN, (len(signatures), 1))
    for k in range(cut.shape[2]):
        keys = mix64(keys + cut[:, :, k])
    return keys


def signed(docs: DataFrame, width: int = 4) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``set_key`` (of the whole set; NULL if empty) and ``bands``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                elements, first = shingle_sets(*utf8(part.column(1)), width)
                sizes = np.diff(first)
                keys = as_signed(band_keys(super_minhash(elements, first)))
                sums = [elements[first[i]:first[i + 1]] for i in range(len(sizes))]
                names = [None if not len(s) else _set_key(s) for s in sums]
                bands = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, keys.size + 1, BANDS, dtype=np.int32)), pa.array(keys.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.binary()), bands],
                    ["doc_id", "n_shingles", "set_key", "bands"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_shingles long, set_key binary, bands array<long>")


def _set_key(elements: np.ndarray) -> bytes:
    from hashlib import blake2b

    return blake2b(elements.tobytes(), digest_size=16).digest()


def _sets(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id``, its ``best`` hub, whether it ``is_hub`` itself, and the set as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                elements, first = shingle_sets(*utf8(part.column(1)), width)
                made = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(as_signed(elements)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), part.column(3), made],
                                                 ["doc_id", "best", "is_hub", "elements"])

    return docs.select("doc_id", "text", "best", "is_hub").mapInArrow(
        run, "doc_id long, best long, is_hub boolean, elements array<long>")


def _linked(percent: int) -> Column:
    """Whether the sets ``elements`` and ``others`` are similar enough; whole numbers, so ties are exact."""
    common = F.size(F.array_intersect("elements", "others"))
    return common * 100 >= percent * (F.size("elements") + F.size("others") - common)


def _met(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b), a written table, with the sets of both, ``elements`` and ``others``.

    Only the sets that a pair names are dealt; the optimizer sees the size of the written pairs.
    """
    left = sets.select(F.col("doc_id").alias("a"), "elements")
    right = sets.select(F.col("doc_id").alias("b"), F.col("elements").alias("others"))
    return pairs.join(left, "a").join(right.join(pairs.select("b"), "b", "left_semi"), "b")


def link(docs: DataFrame, width: int = 4, percent: int = 80) -> DataFrame:
    """Group documents whose sets of ``width``-word shingles have a Jaccard similarity of ``percent`` or more.

    One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (the smallest doc_id reachable by links,
    its own included) and ``kept`` (whether that is its own).  Words are separated by white space, A to Z are
    lower-cased.  Fewer words than ``width`` make one shingle of all; texts that are NULL, empty or blank have no
    shingle and no link.  Rows that repeat a doc_id come back as often as they came, in one component if they
    hold the same text; rows with a NULL doc_id come back with a NULL component_id and ``kept`` true.  An
    empty table gives an empty result.
    """
    table = materialize(signed(docs, width), "signed")
    reps = materialize(
        table.where("set_key IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("set_key").agg(F.min(F.struct("doc_id", "bands")).alias("r"))
        .select("set_key", F.col("r.doc_id").alias("rep"), F.col("r.bands").alias("bands")), "representatives")
    members = reps.select(F.explode("bands").alias("band"), F.col("rep").alias("doc_id"))
    buckets = members.groupBy("band").agg(F.min("doc_id").alias("hub"), F.count("*").alias("n")).where("n > 1")
    # How many buckets a document shares with each hub; a hub shares some with itself.
    votes = materialize(
        members.join(buckets, "band").groupBy("doc_id", "hub").agg(F.count("*").alias("n")), "votes")

    # A document goes to its set with the hub that it shares most buckets with, so that no set is looked up for that.
    other = F.when(F.col("doc_id") != F.col("hub"), F.struct("n", (-F.col("hub")).alias("least"), "hub"))
    named = materialize(
        votes.groupBy("doc_id").agg(F.max(other).alias("v"), F.max(F.col("doc_id") == F.col("hub")).alias("is_hub"))
        .select("doc_id", F.col("v.hub").alias("best"), "is_hub"), "named")
    # Rows that repeat a doc_id with another text: one of the texts is taken.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = materialize(_sets(texts.join(named, "doc_id").dropDuplicates(["doc_id"]), width), "sets")

    members = sets.where("best IS NOT NULL").select(F.col("doc_id").alias("a"), F.col("best").alias("b"), "elements")
    hubs = sets.where("is_hub").select(F.col("doc_id").alias("b"), F.col("elements").alias("others"))
    edges = materialize(members.join(hubs, "b").where(_linked(percent)).select("a", "b"), "links")
    roots = components(edges)
    pairs = materialize(_meeting(votes, roots, sets, percent), "pairs")
    more = materialize(_met(pairs, sets).where(_linked(percent)).select("a", "b"), "links")
    if not more.isEmpty():
        roots = components(edges.union(more))

    rooted = reps.join(roots, reps["rep"] == roots["node"], "left").select(
        "set_key", F.coalesce("root", "rep").alias("root"))
    return (
        table.select("doc_id", "n_shingles", "set_key").join(rooted, "set_key", "left")
        .select("doc_id", "n_shingles",
                F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id")).alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """Rows of ``docs`` (all columns), one of each group of near copies: that of the smallest doc_id.

    Rows equal in doc_id and text are one row, whatever their other columns.  A doc_id with several texts is as many
    documents, and so are the texts without a doc_id, which stay only where no copy has one.  Texts without a word
    stay, an empty table gives an empty result.
    """
    ids = docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
    if ids.isEmpty():
        copies = link(docs, width, percent).where("NOT kept").select("doc_id")
        return docs.join(copies, "doc_id", "left_anti").select(docs.columns)
    # Ids that do not name a row: number the distinct rows in the order of their ids.
    whole = F.struct(*docs.columns)
    rows = (
        docs.groupBy(F.col("doc_id").alias("_nd_id"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("_nd_text"),
                     F.isnull("text").alias("_nd_null"))
        .agg(F.min_by(whole, F.xxhash64(*docs.columns)).alias("_nd_row")))
    order = [F.col("_nd_id").asc_nulls_last(), F.col("_nd_text"), F.col("_nd_null")]
    numbered = materialize(
        materialize(rows, "distinct").repartitionByRange(*order).sortWithinPartitions(*order)
        .select(F.monotonically_increasing_id().alias("_nd_number"), "_nd_row"), "numbered")
    texts = numbered.select(F.col("_nd_number").alias("doc_id"), F.col("_nd_row.text").alias("text"))
    copies = link(texts, width, percent).where("NOT kept").select(F.col("doc_id").alias("_nd_number"))
    return numbered.join(copies, "_nd_number", "left_anti").select("_nd_row.*").select(docs.columns)


def _orders(known: DataFrame, sets: DataFrame) -> DataFrame:
    """For each hub in several components its shingles by how common they are: ``u1``, ``u2``, ... hold those that
    1, 2, ... of its reference members have.  A hub of few members has itself for reference, others ``DRAWN``.
    """
    hubs = known.groupBy("b").agg(
        F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members"),
        *[F.min_by("a", F.xxhash64("a", F.lit(k))).alias(f"r{k}") for k in range(DRAWN)]).where("lo <> hi")
    hubs = materialize(hubs.select(
        "b", "members", F.array_distinct(F.array(*[f"r{k}" for k in range(DRAWN)])).alias("drawn")), "hubs")
    have = sets.select(F.col("doc_id").alias("a"), "elements")
    none = F.array().cast("array<long>")
    few = hubs.where(F.col("members") <= FEW).join(have, F.col("b") == F.col("a")).select(
        "b", F.col("elements").alias("u1"), *[none.alias(f"u{k}") for k in LEVELS[1:]])
    drawn = hubs.where(F.col("members") > FEW).select("b", F.explode("drawn").alias("a")).join(have, "a")
    counted = drawn.select("b", F.explode("elements").alias("e")).groupBy("b", "e").agg(F.count("*").alias("n"))
    many = counted.groupBy("b").agg(
        *[F.collect_list(F.when(F.col("n") >= k, F.col("e"))).alias(f"u{k}") for k in LEVELS])
    return materialize(few.unionByName(many), "orders")


def _meeting(votes: DataFrame, roots: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) that share a hub, are in different components and pass the prefix filter.

    Similar sets of n and m shingles share at least ``percent`` of the larger one, so in any common order the first
    ``n - ceil(percent * n) + 1`` of one and the first ones of the other have a shingle in common.  Behind the first
    common one, in places i and j, there must be enough left for the whole overlap that similar sets have:
    ``min(n - i, m - j) >= percent / (100 + percent) * (n + m)``.
    """
    known = votes.join(roots, votes["doc_id"] == roots["node"], "left").select(
        F.col("doc_id").alias("a"), F.col("hub").alias("b"), F.coalesce("root", "doc_id").alias("root"))
    orders = _orders(known, sets)
    have = sets.select(F.col("doc_id").alias("a"), "elements")
    rest, parts = F.col("elements"), []
    for k in LEVELS:
        parts.append(F.array_except(rest, f"u{k}"))
        rest = F.array_intersect(rest, f"u{k}")
    size = F.size("elements")
    taken = size - F.ceil(size * percent / 100).cast("int") + 1
    # Written, so that the optimizer knows how few documents it looks up the sets of.
    asked = materialize(known.join(orders.select("b"), "b", "left_semi"), "asked")
    firsts = materialize(
        asked.join(have, "a").join(orders, "b")
        .select("a", "root", size.alias("n"), "b",
                F.posexplode(F.slice(F.concat(*parts, rest), F.lit(1), taken)).alias("i", "e"))
        .select(F.col("a").alias("doc_id"), "root", "n", (F.col("n") - F.col("i")).alias("left"),
                F.xxhash64("b", "e").alias("place")), "firsts")
    shared = firsts.groupBy("place").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi")
    left = materialize(firsts.join(shared.select("place"), "place"), "shared")
    right = left.select("place", F.col("doc_id").alias("b"), F.col("root").alias("other"), F.col("n").alias("m"), F.col("left").alias("rest"))
    near = (F.least("left", "rest") * (100 + percent) >= (F.col("n") + F.col("m")) * percent) & (F.col("root") != F.col("other"))
    return left.join(right, "place").where(near & (F.col("b") < F.col("doc_id"))).select(
        F.col("doc_id").alias("a"), "b").distinct()
