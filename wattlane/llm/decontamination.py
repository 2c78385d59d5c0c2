"""Benchmark decontamination: CGK embedding, repeated bit-sampling LSH, exact edit verification.

The CGK random walk copies a string symbol by symbol and moves on or stays by a random bit that depends on
the step and the symbol, so strings at a small edit distance get walks at a small Hamming distance.  A table
of the LSH samples ``SAMPLED`` steps of a walk; an item and a window of the item's size collide where all of
them agree.  ``WALKS`` walks with ``TABLES`` tables each reach a recall above 0.95 at the edit bound itself
and above 0.99 at half of it (measured in the tests).

Windows are laid where they can matter: a text within ``e`` edits of an item keeps one of the ``e + 1``
stretches that the item is cut into, so a window starts where a stretch says that the item would start.  Each
collision is verified by an exact edit distance (bit-parallel, best end inside the window's surroundings).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattlane.llm.texts import slices, without

#: Edits that a passage may have, as a share of the item's characters.
SHARE = 0.08
WALKS, TABLES, SAMPLED = 12, 6, 3
#: Characters of items that are broadcast at once; a larger benchmark is taken in blocks.
BLOCK_CHARS = 4 << 20
#: Windows that walk together.
_TOGETHER = 2048
#: Characters whose grams are hashed at once.
_CHARS = 1 << 18
_FILTER_BITS = 20

LEAKS = T.ArrayType(T.StructType([
    T.StructField("item_id", T.LongType()), T.StructField("edits", T.LongType()),
    T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))


def normalized(text: str | None) -> str:
    """Lower case, runs of white space as one space; case and line breaks are no edits."""
    return " ".join(text.lower().split()) if text else ""


def edit_bound(n: int, share: float = SHARE) -> int:
    return int(share * n)


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _scramble(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * np.uint32(0x45D9F3B)
    return (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)


def spread(codes: np.ndarray, start: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """The strings from ``start`` to ``limit`` in ``codes`` as rows of a matrix; at least one 0 ends each."""
    size = np.maximum(limit - start, 0)
    columns = np.arange(int(size.max(initial=0)) + 1)
    places = np.minimum(start[:, None] + columns, max(len(codes) - 1, 0))
    symbols = codes[places]
    return np.where(columns < size[:, None], symbols ^ (symbols >> np.uint32(16)), 0).astype(np.uint16)


def walk(strings: np.ndarray, steps: int, seed: int) -> np.ndarray:
    """CGK embeddings (a row per step, a column per string) of the rows of ``strings``; 0 after an end."""
    bits = _scramble(_scramble(np.arange(steps * 256, dtype=np.uint32)) + np.uint32(seed)) >> np.uint32(16) & np.uint32(1)
    bits = bits.astype(np.int32).reshape(steps, 256)
    bits[:, 0] = 0  # nothing moves on from an end
    symbols = strings.reshape(-1)
    classes = np.where(symbols == 0, 0, symbols % np.uint16(255) + 1).astype(np.uint8)
    at = np.arange(len(strings), dtype=np.int32) * np.int32(strings.shape[1])
    out = np.zeros((steps, len(strings)), np.uint16)
    for step in range(steps):
        np.take(symbols, at, out=out[step])
        at += bits[step][classes[at]]
    return out


def _steps(n: np.ndarray) -> np.ndarray:
    """Sampled steps of every table of one walk, for strings of ``n`` characters (a row each)."""
    share = np.random.default_rng(20240).random((WALKS, TABLES * SAMPLED))
    return (share[:, None, :] * (2 * n)[None, :, None]).astype(np.int64)


@dataclass(frozen=True)
class Items:
    """A block of benchmark items with what the scan needs: stretches and sampled walks."""

    ids: list[int]
    texts: list[str]
    gram: int
    hashes: np.ndarray    # sorted hashes of the stretches' first grams
    where: np.ndarray     # (item, offset) of each
    samples: np.ndarray   # walk, item, sampled symbol
    steps: np.ndarray     # walk, item, sampled step
    share: float
    exact: list[tuple[int, str]]  # items too short for an edit


def _gram_hashes(codes: np.ndarray, gram: int) -> np.ndarray:
    """Rolling hash of every ``gram`` characters."""
    total = np.zeros(len(codes) - gram + 1, np.uint32)
    for k in range(gram):
        total = total * np.uint32(0x01000193) + codes[k:len(codes) - gram + 1 + k]
    return _scramble(total)


def prepare(rows: list[tuple[int, str | None]], share: float = SHARE) -> Items | None:
    """Stretches and walks of items (id, text); items without text match nothing."""
    every = sorted(((i, normalized(t)) for i, t in rows if normalized(t)), key=lambda x: (x[1], x[0] is None, x[0] or 0))
    exact = [(i, t) for i, t in every if not edit_bound(len(t), share)]
    kept = [(i, t) for i, t in every if edit_bound(len(t), share)]
    if not every:
        return None
    ids, texts = [i for i, _ in kept], [t for _, t in kept]
    if not kept:
        nothing = np.empty((0, 2), np.int64)
        return Items([], [], 1, np.empty(0, np.uint32), nothing, np.empty(0), np.empty(0), share, exact)
    sizes = np.array([len(t) for t in texts])
    cuts = [[int(len(t) / (edit_bound(len(t), share) + 1) * k) for k in range(edit_bound(len(t), share) + 1)] for t in texts]
    gram = min(len(t) // len(c) for t, c in zip(texts, cuts, strict=True))
    hashes, where = [], []
    for i, (text, cut) in enumerate(zip(texts, cuts, strict=True)):
        found = _gram_hashes(_codes(text), gram)
        for offset in cut:
            hashes.append(found[offset])
            where.append((i, offset))
    order = np.argsort(np.array(hashes, np.uint32), kind="stable")
    codes = _codes("".join(texts))
    ends = np.cumsum(sizes)
    steps = _steps(sizes)
    samples = np.zeros((WALKS, len(ids), TABLES * SAMPLED), np.uint16)
    for w in range(WALKS):
        for lo in range(0, len(ids), _TOGETHER):
            part = slice(lo, lo + _TOGETHER)
            made = walk(spread(codes, ends[part] - sizes[part], ends[part]), int(2 * sizes[part].max()), w)
            samples[w, part] = made[steps[w, part], np.arange(made.shape[1])[:, None]]
    return Items(ids, texts, gram, np.array(hashes, np.uint32)[order], np.array(where, np.int64)[order], samples, steps, share, exact)


def edits_within(pattern: str, text: str) -> tuple[int, int]:
    """The fewest edits between ``pattern`` and any stretch of ``text``, and where the first such one ends."""
    n = len(pattern)
    masks: dict[str, int] = {}
    for k, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << k
    full, top = (1 << n) - 1, 1 << (n - 1)
    up, down, score, best, end = full, 0, n, n, 0
    for k, c in enumerate(text):
        same = masks.get(c, 0)
        across = same | down
        diagonal = ((same & up) + up ^ up) | same
        plus = down | full & ~(diagonal | up)
        minus = up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
            if score < best:
                best, end = score, k + 1
        plus <<= 1
        minus <<= 1
        up = full & (minus | ~(across | plus))
        down = plus & across & full
    return best, end


def _windows(items: Items, codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, items and starts of the windows in a row of documents (``first``: where each begins)."""
    size = 1 << _FILTER_BITS
    likely = np.zeros(size, bool)
    likely[items.hashes >> np.uint32(32 - _FILTER_BITS)] = True
    at, hit = [np.empty(0, np.int64)], [np.empty(0, np.uint32)]
    for lo in range(0, max(len(codes) - items.gram + 1, 0), _CHARS):
        found = _gram_hashes(codes[lo:lo + _CHARS + items.gram - 1], items.gram)
        some = np.flatnonzero(likely[found >> np.uint32(32 - _FILTER_BITS)])
        at.append(some + lo)
        hit.append(found[some])
    at, hit = np.concatenate(at), np.concatenate(hit)
    lo, hi = np.searchsorted(items.hashes, hit, "left"), np.searchsorted(items.hashes, hit, "right")
    count = hi - lo
    which = np.repeat(lo, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    item, offset = items.where[which, 0], items.where[which, 1]
    place = np.repeat(at, count)
    doc = np.searchsorted(first, place, "right") - 1
    start = np.maximum(place - offset, first[doc])
    rows = np.unique(np.stack([doc, item, start], axis=1), axis=0) if len(doc) else np.empty((0, 3), np.int64)
    return rows[:, 0], rows[:, 1], rows[:, 2]


def collide(items: Items, codes: np.ndarray, item: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Which windows (from ``start``, of the item's size, up to ``end`` at most) meet their item in a table."""
    sizes = np.array([len(t) for t in items.texts])
    met = np.zeros(len(item), bool)
    order = np.argsort(sizes[item], kind="stable")
    for lo in range(0, len(order), _TOGETHER):
        rest = order[lo:lo + _TOGETHER]
        strings = spread(codes, start[rest], np.minimum(start[rest] + sizes[item[rest]], end[rest]))
        for w in range(WALKS):
            mine = item[rest]
            made = walk(strings, int(2 * sizes[mine].max()), w)
            got = made[items.steps[w, mine], np.arange(len(rest))[:, None]] == items.samples[w, mine]
            hit = got.reshape(len(rest), TABLES, SAMPLED).all(axis=2).any(axis=1)
            met[rest[hit]] = True
            rest, strings = rest[~hit], strings[~hit]
            if not len(rest):
                break
    return met


def leaks(items: Items, texts: list[str | None]) -> list[list[dict]]:
    """For each text the items it holds within the edit bound: id, edits, start and end in the normalized text."""
    plain = [normalized(t) for t in texts]
    found: list[dict[int, tuple[int, int, int]]] = [{} for _ in texts]
    short = [
        [{"item_id": i, "edits": 0, "start": p.find(t), "end": p.find(t) + len(t)} for i, t in items.exact if t in p] for p in plain
    ]
    codes = _codes("\0".join([*plain, ""]))
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in plain])])[:-1]
    doc, item, start = _windows(items, codes, first)
    if len(doc):
        end = first[doc] + np.array([len(t) for t in plain])[doc]
        met = collide(items, codes, item, start, end)
        # A passage is found from each of its stretches; regions that overlap one already verified add nothing.
        for d, i, s in zip(doc[met].tolist(), item[met].tolist(), (start - first[doc])[met].tolist(), strict=True):
            text = items.texts[i]
            bound = edit_bound(len(text), items.share)
            best = found[d].get(i)
            if best and (best[0] == 0 or abs(best[1] - s) <= bound):
                continue
            lo = max(0, s - bound)
            edits, stop = edits_within(text, plain[d][lo:s + len(text) + bound])
            if edits <= bound and (best is None or edits < best[0]):
                found[d][i] = (edits, s, lo + stop)
    return [
        [{"item_id": items.ids[i], "edits": e, "start": s, "end": t} for i, (e, s, t) in sorted(f.items())] + own
        for f, own in zip(found, short, strict=True)
    ]


def mark(
    spark: SparkSession, docs: DataFrame, benchmark: DataFrame, share: float = SHARE, text: str = "text"
) -> DataFrame:
    """``docs`` with ``leaks``: the benchmark items found in each whole text (empty where there are none).

    ``benchmark`` has ``item_id`` and ``text``; NULL and empty items match nothing, items of equal text are
    all named.  NULL and empty documents have no leaks.  A column ``leaks`` in ``docs`` is replaced.
    """
    kept = without(docs, "leaks")
    schema = T.StructType([*docs.select(kept).schema.fields, T.StructField("leaks", LEAKS)])
    at = kept.index(text)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    out = docs.select(kept).withColumn("leaks", F.array().cast(LEAKS))
    for block in range(blocks):
        mine = items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block) if blocks > 1 else items
        prepared = prepare([(r[0], r[1]) for r in mine.collect()], share)
        if prepared is None:
            continue
        out = out.mapInArrow(_scan(spark.sparkContext.broadcast(prepared), at), schema)
    return out


def _scan(shared, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                new = leaks(shared.value, part.column(at).to_pylist())
                if part.num_rows and any(new):
                    old = part.column(part.num_columns - 1).to_pylist()
                    made = pa.array([a + b for a, b in zip(old, new, strict=True)], part.schema.field("leaks").type)
                    part = pa.RecordBatch.from_arrays([*part.columns[:-1], made], schema=part.schema)
                yield part
    return run


def leaked(marked: DataFrame) -> DataFrame:
    """One row per document and item: ``doc_id``, ``item_id``, ``edits``, ``start``, ``end``."""
    return marked.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")
