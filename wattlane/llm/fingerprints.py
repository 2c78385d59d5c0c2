"""Document fingerprints from closed syncmers.

A k-mer of characters is a closed syncmer if the smallest of the s-mers in it (by hash) stands at one of its edges.
That depends on the k-mer alone, so the same passage has the same anchors in any text.  A fingerprint keeps the
hashes of all syncmers of a text of any length, each with the place where it stands first.  Two fingerprints are as
alike as the share of the hashes of both together that both have, counting only anchors that agree on how far the
texts are shifted against each other.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattlane.llm.texts import slices, text_bytes

K, S = 16, 6
#: Characters by which the shifts of two anchors of one alignment may differ.
SLACK = 200
#: Bytes of text that a block of consecutive documents holds on average.
BLOCK_BYTES = 4 << 20

_LOWEST = -(1 << 63)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _rolled(codes: np.ndarray, n: int) -> np.ndarray:
    out = np.zeros(len(codes) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + codes[k:len(codes) - n + 1 + k]
    return _scramble(out)


def syncmers(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Hashes (32 bits) and places of a text's closed syncmers; a text of fewer than ``K`` characters is its own."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    if not len(codes):
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    if len(codes) < K:
        return (_rolled(codes, len(codes)) >> np.uint64(32)).astype(np.uint32), np.zeros(1, np.int64)
    small = _rolled(codes, S)
    span = K - S + 1
    n = len(codes) - K + 1
    low, width = small, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    low = np.minimum(low[:n], low[span - width:span - width + n])
    places = np.flatnonzero((small[:n] == low) | (small[span - 1:span - 1 + n] == low))
    # Hashes of the chosen k-mers only: s-mers cover a k-mer without gaps.
    mixed = np.zeros(len(places), np.uint64)
    for at in [*range(0, K - S + 1, S), K - S]:
        mixed = _scramble(mixed * np.uint64(0x9E3779B97F4A7C15) + small[places + at])
    return (mixed >> np.uint64(32)).astype(np.uint32), places


def sketch(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes of a text's syncmers, rising, and the first place of each."""
    return _distinct(*syncmers(text))


def _distinct(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, first = np.unique(hashes, return_index=True)
    return found, places[first]


def written(made: tuple[np.ndarray, np.ndarray]) -> str:
    """A fingerprint as text: hash in hex and place in base ten, in the order of the hashes."""
    return " ".join(f"{h:08x}:{p}" for h, p in zip(made[0].tolist(), made[1].tolist(), strict=True))


def likeness(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """0 to 1; equal fingerprints give 1, also two of empty texts."""
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    common, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    shift = np.sort(a[1][i] - b[1][j])
    # The most anchors whose shifts lie within SLACK of each other.
    agree = (np.searchsorted(shift, shift + SLACK, side="right") - np.arange(len(shift))).max()
    return float(agree / (len(a[0]) + len(b[0]) - len(common)))


def _bounds(docs: DataFrame) -> list[int]:
    """Cuts of the doc_ids into blocks of about ``BLOCK_BYTES`` of text; one number per block."""
    blocks = -(-text_bytes(docs) // BLOCK_BYTES)
    if blocks < 2:
        return []
    cuts = docs.select(F.col("key").cast("double")).stat.approxQuantile("key", [k / blocks for k in range(1, blocks)], 0.1 / blocks)
    return sorted({int(c) for c in cuts})


def compare(docs: DataFrame) -> DataFrame:
    """Fingerprints of each whole text and of its edited text, and how alike they are.

    The edited text has the last third of the characters (rounded down) replaced by as many first ones of the
    next document, by falling doc_id; the last document's next is the first.  ``doc_id``, ``n_chars``,
    ``edited_sha256``, ``fingerprint``, ``edited_fingerprint``, ``near_edited``, ``near_next``, ``anchors`` (syncmers of
    the text, repeated ones too).  NULL counts as the empty text, whose fingerprint is empty.  Rows with a NULL doc_id come last;
    rows that share a doc_id are ordered by their texts.  An empty table gives an empty result.

    Documents are dealt into blocks of consecutive doc_ids; a block also gets the first document of the block that
    follows, so every document meets its next one in one shuffle.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOWEST)).alias("key"))
    cuts = np.array(_bounds(rows), np.int64)

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.searchsorted(cuts, batch.column(0).to_numpy(zero_copy_only=False), side="right")
            yield pa.RecordBatch.from_arrays([pa.array(block), batch.column(0)], ["block", "key"])

    tops = rows.select("key").mapInArrow(numbered, "block long, key long").groupBy("block").agg(F.max("key").alias("top"))
    top = {r["block"]: r["top"] for r in tops.collect()}  # one row per block
    order = sorted(top)
    goes_to = {top[b]: order[(k + 1) % len(order)] for k, b in enumerate(order)}

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                keys = part.column(2).to_numpy(zero_copy_only=False)
                block = np.searchsorted(cuts, keys, side="right")
                firsts = np.array([k for k in range(len(keys)) if int(keys[k]) in goes_to], np.int64)
                at = np.concatenate([np.arange(len(keys)), firsts]).astype(np.int64)
                to = np.concatenate([block, [goes_to[int(keys[k])] for k in firsts]]).astype(np.int64)
                own = np.arange(len(at)) < len(keys)
                took = part.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([*took.columns, pa.array(to), pa.array(own)],
                                                 ["doc_id", "text", "key", "block", "own"])

    def matched(frame: pd.DataFrame) -> pd.DataFrame:
        own = frame[frame["own"]].sort_values(["key", "text"], ascending=False, kind="stable")
        # Copies that end the block: the first of the block below, or of all.
        after = frame[~frame["own"]].sort_values(["key", "text"], ascending=False, kind="stable")
        texts = [*own["text"], after["text"].iloc[0]]
        anchors, out = syncmers(texts[0]), []
        made = _distinct(*anchors)
        for k, text in enumerate(texts[:-1]):
            anchors_after = syncmers(texts[k + 1])
            following = _distinct(*anchors_after)
            third = len(text) // 3
            edited = text[:len(text) - third] + texts[k + 1][:third]
            changed = sketch(edited)
            out.append((len(text), sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), written(made), written(changed),
                        likeness(made, changed), likeness(made, following), len(anchors[0])))
            anchors, made = anchors_after, following
        result = pd.DataFrame(out, columns=[
            "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "anchors"])
        result.insert(0, "doc_id", own["doc_id"].astype("Int64").array)
        return result

    return rows.mapInArrow(dealt, "doc_id long, text string, key long, block long, own boolean").groupBy("block").applyInPandas(
        matched, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double, anchors long")
