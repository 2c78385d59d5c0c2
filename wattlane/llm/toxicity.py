"""Toxicity: a convolutional text classifier over hashed word embeddings, trained in numpy.

A word is the sum of two embeddings, of its hash and of the hash of its first letters.  Filters of several widths
slide over the words, each keeps its largest value over the whole text (max pooling), and a logistic layer makes
the score.  Every labelled row counts: a quarter calibrates, all others fit.  Up to ``ROWS`` labelled rows are fitted in
one task.  More are dealt to shards of about ``ROWS``; weights start from one shard, then each round goes through
all shards side by side and takes the mean of their weights.  The fitted score is shifted so that 0.5 is the best
cut, and a cut of its own is calibrated for each language.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from copy import deepcopy
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from wattlane.llm.texts import slices, utf8, word_hashes, word_spans
from wattlane.session import materialize

#: About so many labelled rows make a shard.
ROWS = 6000
#: Rounds through all shards, after the start.
ROUNDS = 2
#: Parts that the weights of a shard are sent in, and steps a unit of logits that calibration tells apart.
PIECES, FINE = 16, 1024
BUCKETS, SIZE, WIDTHS, FILTERS, HEAD = 1 << 15, 16, (1, 2, 3), 16, 4
EPOCHS, STEPS, BATCH, RATE = 6, 400, 32, 0.01
#: Of the labelled rows, the share held back to calibrate cuts; cuts of languages need so many of them.
HELD, ENOUGH = 0.25, 30
#: Words whose filters are computed at once.
_WORDS = 1 << 16

_INSIDE = np.zeros(256, bool)
_INSIDE[48:58] = _INSIDE[65:91] = _INSIDE[97:123] = _INSIDE[128:] = True
#: Rows of the embedding for the place behind a text; it stays zero.
_PAD = 2 * BUCKETS


@dataclass
class Net:
    table: np.ndarray
    filters: list[np.ndarray]
    offsets: list[np.ndarray]
    out: np.ndarray
    bias: float
    cut: float = 0.0
    cuts: dict[str, float] = field(default_factory=dict)


def word_rows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Embedding rows of each word and of its head, two places of padding behind each text, and where texts begin.

    A text without words has one word of padding, so that it has a place to look at.
    """
    starts, ends, first = word_spans(data, offsets, _INSIDE)
    whole = (word_hashes(data, starts, ends) % np.uint64(BUCKETS)).astype(np.int32)
    heads = (word_hashes(data, starts, np.minimum(ends, starts + HEAD)) % np.uint64(BUCKETS)).astype(np.int32) + BUCKETS
    counts = np.diff(first)
    room = np.maximum(counts, 1) + 2
    begin = np.cumsum(room) - room
    total = int(room.sum())
    rows = np.full((2, total), _PAD, np.int32)
    at = np.repeat(begin - first[:-1], counts) + np.arange(len(starts))
    rows[0, at], rows[1, at] = whole, heads
    return rows[0], rows[1], np.concatenate([begin, [total]])


def pooled(net: Net, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The largest value of every filter over each text, whole texts piece by piece."""
    texts = len(first) - 1
    best = np.full((texts, len(WIDTHS) * FILTERS), -np.inf, np.float32)
    total = len(a)
    for lo in range(0, total, _WORDS):
        hi = min(total, lo + _WORDS)
        x = net.table[a[lo:hi + 2]] + net.table[b[lo:hi + 2]]
        x = np.vstack([x, np.zeros((hi + 2 - lo - len(x), SIZE), np.float32)])
        d0, d1 = np.searchsorted(first, lo, "right") - 1, np.searchsorted(first, hi, "left")
        begin = np.maximum(first[d0:d1], lo) - lo
        values = []
        for w, weights, offset in zip(WIDTHS, net.filters, net.offsets, strict=True):
            z = x[:hi - lo] @ weights[0]
            for k in range(1, w):
                z += x[k:hi - lo + k] @ weights[k]
            values.append(z + offset)
        z = np.hstack(values)
        # Windows that begin behind a text would reach into the next one.
        stop = first[1:][d0:d1]
        behind = np.concatenate([stop - 2, stop - 1]) - lo
        z[behind[(behind >= 0) & (behind < hi - lo)]] = -np.inf
        best[d0:d1] = np.maximum(best[d0:d1], np.maximum.reduceat(z, begin, axis=0))
    return best


def logits(net: Net, a: np.ndarray, b: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.maximum(pooled(net, a, b, first), 0) @ net.out + net.bias


def blank(draw: np.random.Generator) -> Net:
    net = Net(
        (draw.normal(0, 0.1, (2 * BUCKETS + 1, SIZE))).astype(np.float32),
        [draw.normal(0, (w * SIZE) ** -0.5, (w, SIZE, FILTERS)).astype(np.float32) for w in WIDTHS],
        [np.zeros(FILTERS, np.float32) for _ in WIDTHS],
        draw.normal(0, 0.2, len(WIDTHS) * FILTERS).astype(np.float32), 0.0)
    net.table[_PAD] = 0
    return net


class Adam:
    """Steps of a net's weights, with their moments."""

    def __init__(self, net: Net):
        self.net, self.step = net, 0
        self.params = [net.table, *net.filters, *net.offsets, net.out]
        self.moments = [(np.zeros_like(p), np.zeros_like(p)) for p in self.params]

    def go_through(self, encoded: list, labels: np.ndarray, weight: np.ndarray, used: np.ndarray) -> None:
        """One pass over the rows ``used``, in their order."""
        net, params = self.net, self.params
        for at in range(0, len(used), BATCH):
            batch = used[at:at + BATCH]
            grads = [np.zeros_like(p) for p in params[1:]]
            rows, values, slope = [], [], 0.0
            for i in batch:
                a, b, _ = encoded[i]
                n = len(a) - 2
                x = net.table[a] + net.table[b]
                places, tops = [], []
                for w, weights, offset in zip(WIDTHS, net.filters, net.offsets, strict=True):
                    z = sum(x[k:n + k] @ weights[k] for k in range(w)) + offset
                    place = z.argmax(axis=0)
                    places.append(place)
                    tops.append(z[place, np.arange(FILTERS)])
                top = np.maximum(np.concatenate(tops), 0)
                error = (1 / (1 + np.exp(-np.clip(top @ net.out + net.bias, -30, 30))) - labels[i]) * weight[i] / len(batch)
                grads[-1] += error * top
                slope += error
                back = error * net.out * (top > 0)
                for j, w in enumerate(WIDTHS):
                    g = back[j * FILTERS:(j + 1) * FILTERS]
                    grads[len(WIDTHS) + j] += g
                    for k in range(w):
                        near = places[j] + k
                        grads[j][k] += x[near].T * g
                        moved = (net.filters[j][k] * g).T
                        rows += [a[near], b[near]]
                        values += [moved, moved]
            table = np.zeros_like(net.table)
            np.add.at(table, np.concatenate(rows), np.concatenate(values).astype(np.float32))
            table[_PAD] = 0
            self.step += 1
            for p, g, (m, v) in zip(params, [table, *grads], self.moments, strict=True):
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= RATE * (m / (1 - 0.9 ** self.step)) / (np.sqrt(v / (1 - 0.99 ** self.step)) + 1e-6)
            net.bias -= RATE * float(slope)


def train(texts: list[str], labels: np.ndarray, languages: list[str | None], seed: int = 7) -> Net:
    """Fit by Adam on whole texts; part of the rows only calibrates the cuts."""
    draw = np.random.default_rng(seed)
    net = blank(draw)
    encoded = [word_rows(*utf8(pa.array([t], pa.string()))) for t in texts]
    order = draw.permutation(len(texts))
    held = order[:int(len(order) * HELD)]
    used = order[int(len(order) * HELD):]
    steps = Adam(net)
    # Few rows are gone through more often; both classes weigh the same.
    weight = np.where(labels == 1, 0.5 / max(labels.mean(), 1e-9), 0.5 / max(1 - labels.mean(), 1e-9))
    for _ in range(max(EPOCHS, -(-STEPS * BATCH // max(len(used), 1)))):
        draw.shuffle(used)
        steps.go_through(encoded, labels, weight, used)
    seen = held if len(held) else order
    z = np.array([logits(net, *encoded[i])[0] for i in seen])
    y, lang = labels[seen], np.array([languages[i] or "" for i in seen], object)
    net.cut = best_cut(z, y)
    net.cuts = {
        k: best_cut(z[lang == k], y[lang == k]) for k in sorted(set(lang) - {""}) if (lang == k).sum() >= ENOUGH}
    return net


def best_cut(z: np.ndarray, y: np.ndarray) -> float:
    """The cut with the fewest errors, each class weighing the same; in the middle between two values."""
    if not len(z) or y.min() == y.max():
        return 0.0
    order = np.argsort(z, kind="stable")
    z, y = z[order], y[order]
    return _cheapest(z, y, 1 - y)


def _cheapest(z: np.ndarray, toxic: np.ndarray, clean: np.ndarray) -> float:
    """``best_cut`` of rising values with their numbers of rows."""
    missed = np.concatenate([[0], np.cumsum(toxic)]) / max(toxic.sum(), 1)
    alarms = 1 - np.concatenate([[0], np.cumsum(clean)]) / max(clean.sum(), 1)
    at = np.flatnonzero(missed + alarms == (missed + alarms).min())
    at = int(at[len(at) // 2])
    return float((z[max(at - 1, 0)] + z[min(at, len(z) - 1)]) / 2)


def fit(spark: SparkSession, docs: DataFrame, labels: DataFrame, rows: int = ROWS) -> Net | None:
    """Fit on all texts of ``docs`` (``doc_id``, ``text``, ``lang``) that ``labels`` (``doc_id``, ``toxic``) marks.

    Rows without text or without a label of 0 or 1 are ignored, labels that are repeated count once.  ``lang`` only
    chooses the rows that calibrate a language's cut.  None where a class has no row.
    """
    told = labels.where("toxic IN (0, 1)").select("doc_id", "toxic").distinct()
    texts = docs.where("text IS NOT NULL").select("doc_id", "text", "lang")
    # The same join at every size: a broadcast of small labels only hides what larger ones shuffle.
    known = texts.join(told.hint("merge"), "doc_id").select(F.col("doc_id").cast("string").alias("doc_id"), "toxic", "lang", "text")
    known = materialize(known.mapInArrow(_encode, _ENCODED), "labelled")
    sizes = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    if len(sizes) < 2:
        return None
    if sum(sizes.values()) > rows:
        return _fit_shards(spark, known, sizes, rows)

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "text"])
        net = train(frame["text"].tolist(), frame["toxic"].to_numpy(float), frame["lang"].tolist())
        return pd.DataFrame({"net": [pickle.dumps(net)]})

    few = texts.join(told, "doc_id")
    found = few.groupBy(F.lit(0).alias("one")).applyInPandas(run, "net binary").collect()
    return pickle.loads(found[0]["net"])


_ENCODED = "doc_id string, toxic int, lang string, words binary"


def _encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts become buckets of words and heads, two bytes each, words before heads."""
    for batch in batches:
        for part in slices(batch, 3):
            a, b, first = word_rows(*utf8(part.column(3)))
            words = []
            for lo, hi in zip(first[:-1], first[1:], strict=True):
                real = a[lo:hi] != _PAD
                words.append(np.concatenate([a[lo:hi][real], b[lo:hi][real] - BUCKETS]).astype("<u2").tobytes())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1).cast(pa.int32()), part.column(2), pa.array(words, pa.binary())],
                ["doc_id", "toxic", "lang", "words"])


def _decode(words: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``word_rows`` of the one text."""
    both = np.frombuffer(words, "<u2").astype(np.int32).reshape(2, -1)
    pad = np.full((2, 2 if both.shape[1] else 3), _PAD, np.int32)
    a, b = np.hstack([both + np.array([[0], [BUCKETS]], np.int32), pad])
    return a, b, np.array([0, len(a)])


def _fit_shards(spark: SparkSession, known: DataFrame, sizes: dict[int, int], rows: int) -> Net:
    """Fit on all rows of ``known`` side by side; see the top."""
    place = F.xxhash64("doc_id", "words")
    fits = F.pmod(F.xxhash64(F.lit("held"), "doc_id", "words"), F.lit(1 << 20)) >= int(HELD * (1 << 20))
    total = sum(sizes.values())
    shards = max(1, -(-int(total * (1 - HELD)) // rows))
    dealt = known.where(fits).select("toxic", "words", place.alias("place"), F.pmod(place, F.lit(shards)).alias("shard"))
    net = blank(np.random.default_rng(7))
    net = _mean_weights(spark, dealt.where("shard = 0"), 1, net, sizes, rows, -(-STEPS * BATCH // rows))
    for _ in range(ROUNDS):
        net = _mean_weights(spark, dealt, shards, net, sizes, rows, 1)
    net.cut, net.cuts = _calibrate(spark, known.where(~fits), net)
    return net


def _mean_weights(
    spark: SparkSession, dealt: DataFrame, shards: int, net: Net, sizes: dict[int, int], rows: int, epochs: int
) -> Net:
    """Every shard goes on from ``net`` with its own rows; the mean of what they arrive at, each row weighing the same."""
    shared = spark.sparkContext.broadcast(net)
    total = sum(sizes.values())
    each = {k: 0.5 * total / n for k, n in sizes.items()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state, now, seen, held = None, None, 0, []

        def learn() -> None:
            labels = np.array([y for y, _ in held], float)
            weight = np.where(labels == 1, each[1], each[0])
            encoded = [_decode(words) for _, words in held]
            draw = np.random.default_rng(7)
            for _ in range(epochs):
                state.go_through(encoded, labels, weight, draw.permutation(len(held)))
            held.clear()

        def pieces() -> pa.RecordBatch:
            learn()
            flat = [*np.array_split(state.net.table, PIECES), _rest(state.net)]
            return pa.RecordBatch.from_pydict({
                "piece": pa.array(range(len(flat)), pa.int32()), "shard": pa.array([now] * len(flat), pa.int64()),
                "n": pa.array([seen] * len(flat), pa.int64()),
                "weights": pa.array([np.ascontiguousarray(x, "<f4").tobytes() for x in flat], pa.binary())})

        for batch in batches:
            for shard, toxic, words in zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True):
                if shard != now:
                    if state:
                        yield pieces()
                    state, now, seen = Adam(deepcopy(shared.value)), shard, 0
                held.append((toxic, words))
                seen += 1
                if len(held) >= 2 * rows:  # equal rows can make a shard larger than the others
                    learn()
        if state:
            yield pieces()

    def mean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        counts: dict[int, int] = {}
        for batch in batches:
            for piece, _, n, weights in zip(*(batch.column(c) for c in range(4)), strict=True):
                k, n = piece.as_py(), n.as_py()
                sums[k] = sums.get(k, 0) + np.frombuffer(weights.as_buffer(), "<f4").astype(float) * n
                counts[k] = counts.get(k, 0) + n
        if sums:
            yield pa.RecordBatch.from_pydict({
                "piece": pa.array(list(sums), pa.int32()),
                "weights": pa.array([(x / counts[k]).astype("<f4").tobytes() for k, x in sums.items()], pa.binary())})

    # Twice as many partitions as shards, as they are dealt by hash.
    sent = (
        dealt.select("shard", "toxic", "words", "place").repartition(2 * shards, "shard")
        .sortWithinPartitions("shard", "place", "toxic")
        .mapInArrow(run, "piece int, shard long, n long, weights binary"))
    found = (
        sent.repartition(PIECES + 1, "piece").sortWithinPartitions("piece", "shard")
        .mapInArrow(mean, "piece int, weights binary").collect())
    flat = [np.frombuffer(r["weights"], "<f4").copy() for r in sorted(found, key=lambda r: r["piece"])]
    shared.unpersist()
    return _assemble(flat) if flat else net


def _rest(net: Net) -> np.ndarray:
    """All weights behind the table."""
    return np.concatenate([*[f.ravel() for f in net.filters], *net.offsets, net.out, [net.bias]])


def _assemble(flat: list[np.ndarray]) -> Net:
    ends = np.cumsum([*[w * SIZE * FILTERS for w in WIDTHS], *[FILTERS] * len(WIDTHS), len(WIDTHS) * FILTERS])
    parts = np.split(flat[-1], ends)
    k = len(WIDTHS)
    return Net(
        np.concatenate(flat[:-1]).reshape(2 * BUCKETS + 1, SIZE),
        [x.reshape(w, SIZE, FILTERS) for w, x in zip(WIDTHS, parts[:k], strict=True)], list(parts[k:2 * k]), parts[2 * k],
        float(parts[-1][0]))


def _calibrate(spark: SparkSession, held: DataFrame, net: Net) -> tuple[float, dict[str, float]]:
    """The best cut of all rows, and of each language with enough of them, from counts of rows by logit."""
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 2):
                z = [logits(shared.value, *_decode(words))[0] for words in part.column(2).to_pylist()]
                z = np.rint(np.clip(np.array(z, float), -32, 32) * FINE).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(z)], ["toxic", "lang", "z"])

    def cut(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("z")
        toxic, clean = frame["toxic"].to_numpy(float), frame["clean"].to_numpy(float)
        both = toxic.sum() > 0 and clean.sum() > 0
        best = _cheapest(frame["z"].to_numpy(float) / FINE, toxic, clean) if both else 0.0
        return pd.DataFrame({
            "whole": [bool(frame["whole"].iloc[0])], "lang": [frame["lang"].iloc[0]],
            "rows": [int(toxic.sum() + clean.sum())], "cut": [best]})

    counts = (
        held.select("toxic", "lang", "words").mapInArrow(run, "toxic int, lang string, z int")
        .withColumn("whole", F.explode(F.array(F.lit(True), F.lit(False))))
        .withColumn("lang", F.when(~F.col("whole"), F.coalesce("lang", F.lit(""))).otherwise(""))
        .where("whole OR lang <> ''")
        .groupBy("whole", "lang", "z").agg(F.sum("toxic").alias("toxic"), F.sum(1 - F.col("toxic")).alias("clean")))
    found = counts.groupBy("whole", "lang").applyInPandas(
        cut, "whole boolean, lang string, rows long, cut double").where(F.col("whole") | (F.col("rows") >= ENOUGH)).collect()
    return (
        next((r["cut"] for r in found if r["whole"]), 0.0),
        {r["lang"]: r["cut"] for r in sorted(found, key=lambda r: r["lang"]) if not r["whole"]})


def score(spark: SparkSession, docs: DataFrame, net: Net | None) -> DataFrame:
    """``doc_id``, ``score`` (0 to 1), ``predicted`` (1 from 0.5 up), and by the language named in ``lang``:
    ``threshold`` (0.5 where none is calibrated) and ``flagged`` (whether the score reaches it).

    NULL and empty texts are scored like a text without words.  Without a fitted net every score is 0.
    """
    shared = spark.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = shared.value
        for batch in batches:
            for part in slices(batch, 1):
                n = part.num_rows
                z = logits(net, *word_rows(*utf8(part.column(1)))).astype(float) if net else np.full(n, -np.inf)
                cut = net.cut if net else 0.0
                share = 1 / (1 + np.exp(-np.clip(z - cut, -30, 30))) if net else np.zeros(n)
                own = [net.cuts.get(k, cut) if net else 0.0 for k in part.column(2).to_pylist()]
                own = 1 / (1 + np.exp(-np.clip(np.array(own, float) - cut, -30, 30)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(share), pa.array((share >= 0.5).astype(np.int32)), pa.array(own),
                     pa.array(share >= own)], ["doc_id", "score", "predicted", "threshold", "flagged"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang").mapInArrow(
        run, "doc_id long, score double, predicted int, threshold double, flagged boolean")
