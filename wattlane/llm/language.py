"""Language identification: multinomial naive Bayes over hashed character n-grams.

Counts of hashed bigrams and trigrams per language are summed in Spark over a bounded sample of labelled
documents (``per_language`` of each, whole texts).  The matrix of log probabilities has ``BUCKETS`` rows and
one column per language.  It is broadcast, and batches of texts are scored as sparse rows: gather the matrix at
the hashed grams, sum between document borders.  More than ``AT_ONCE`` languages are scored in blocks of columns,
one pass each, so that what a task holds does not grow with the number of languages.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from wattlane.llm.texts import slices, without
from wattlane.session import materialize

BUCKETS = 1 << 15
#: Languages whose columns are broadcast at once (128 KB each).
AT_ONCE = 200
#: About so many labelled rows of each language are used for fitting.
PER_LANGUAGE = 1500
UNDETERMINED = "und"

_LETTER = regex.compile(r"\p{L}")
#: ASCII characters other than letters stand for a gap between words.
_GAP = np.array([not chr(c).isalpha() for c in range(128)])
#: Characters of a long text that are hashed at once.
_CHARS = 1 << 19


@dataclass(frozen=True)
class LanguageModel:
    """``table``: log probabilities, one row per bucket and a last row of zeros; ``prior``: log shares."""

    languages: tuple[str, ...]
    table: np.ndarray
    prior: np.ndarray


def _grams(chars: np.ndarray, ends: np.ndarray, goes_on: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the bigram and the trigram that begin at each character; those that would reach past a
    border in ``ends`` get the bucket of zeros, as do those that the next piece of the same text counts."""
    c = chars.astype(np.uint32)
    ascii_ = c < 128
    c[ascii_] = np.where(_GAP[c[ascii_]], np.uint32(32), c[ascii_])
    pad = np.concatenate([c, np.zeros(2, np.uint32)])
    two = pad[:-2] * np.uint32(0x9E3779B1) + pad[1:-1] * np.uint32(0x85EBCA77)
    three = two * np.uint32(0xC2B2AE3D) + pad[2:] * np.uint32(0x27D4EB2F)
    shift = np.uint32(32 - BUCKETS.bit_length() + 1)
    two, three = ((x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D) >> shift for x in (two, three))
    two, three = two.astype(np.int32), three.astype(np.int32)
    two[ends - 1] = BUCKETS
    two[ends[goes_on] - 2] = BUCKETS
    three[ends - 1] = BUCKETS
    three[np.maximum(ends - 2, 0)] = BUCKETS
    return two, three


def _pieces(texts: list[str | None]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Characters of lower-cased texts (each followed by a gap), the texts they belong to, their ends, and whether
    a text goes on behind them.

    A long text comes in several pieces that overlap by two characters, so every gram is in one of them.
    """
    owners, parts, more, size = [], [], [], 0
    for i, text in enumerate(texts):
        if not text:
            continue
        text = text.lower() + " "
        for at in range(0, max(len(text) - 2, 1), _CHARS):
            part = text[at:at + _CHARS + 2]
            owners.append(i)
            parts.append(part)
            more.append(at + len(part) < len(text))
            size += len(part)
            if size >= _CHARS:
                yield _coded(owners, parts, more)
                owners, parts, more, size = [], [], [], 0
    if parts:
        yield _coded(owners, parts, more)


def _coded(
    owners: list[int], parts: list[str], more: list[bool]
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return chars, np.array(owners), np.cumsum([len(p) for p in parts]), np.array(more, bool)


def fit(
    docs: DataFrame, label: str = "lang", text: str = "text", key: str = "doc_id", per_language: int = PER_LANGUAGE
) -> LanguageModel:
    """Fit on labelled rows: rows without a label or text are ignored, no labels give a model without languages.

    Every label is learned; the model takes 128 KB a language.
    """
    known = docs.select(
        F.col(key).alias("key"), F.col(label).alias("label"), F.col(text).alias("text")
    ).where("label IS NOT NULL AND text IS NOT NULL")
    counts = materialize(known.groupBy("label").count(), "labels")
    sizes = counts.collect()
    if not sizes:
        return LanguageModel((), np.zeros((BUCKETS + 1, 0), np.float32), np.zeros(0, np.float32))
    names = sorted(r["label"] for r in sizes)
    draw = F.pmod(F.xxhash64(F.col("key").cast("string"), F.lit("fit")), F.lit(1 << 20)) / (1 << 20)
    rate = F.least(F.lit(1.0), per_language / F.col("count"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, np.ndarray] = {}
        for batch in batches:
            for part in slices(batch, 1):
                labels = np.array(part.column(0).to_pylist(), object)
                for chars, owners, ends, more in _pieces(part.column(1).to_pylist()):
                    starts = np.concatenate([[0], ends[:-1]])
                    both = _grams(chars, ends, more)
                    for name in set(labels[owners]):
                        mine = np.repeat(labels[owners] == name, ends - starts)
                        for grams in both:
                            found.setdefault(name, np.zeros(BUCKETS + 1))
                            found[name] += np.bincount(grams[mine], minlength=BUCKETS + 1)
        rows = [(n, np.flatnonzero(v[:BUCKETS])) for n, v in found.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([n for n, _ in rows], pa.string()),
             pa.array([at.astype(np.int32) for _, at in rows], pa.list_(pa.int32())),
             pa.array([found[n][at] for n, at in rows], pa.list_(pa.float64()))], ["label", "bucket", "n"])

    counted = (
        known.join(counts, "label").where(draw < rate).select("label", "text")
        .mapInArrow(count, "label string, bucket array<int>, n array<double>")
        .select("label", F.explode(F.arrays_zip("bucket", "n")).alias("cell"))
        .groupBy("label", "cell.bucket").agg(F.sum("cell.n").alias("n"))
        .groupBy("label").agg(F.collect_list(F.struct("bucket", "n")).alias("cells"))
    )
    logs, place = np.full((BUCKETS, len(names)), -np.log(BUCKETS), np.float32), {n: i for i, n in enumerate(names)}
    for row in counted.toLocalIterator():
        column = np.full(BUCKETS, 0.5)
        for cell in row["cells"]:
            column[cell["bucket"]] += cell["n"]
        logs[:, place[row["label"]]] = np.log(column / column.sum())
    shares = np.array([{r["label"]: r["count"] for r in sizes}[n] for n in names], float)
    return LanguageModel(
        tuple(names),
        np.vstack([logs, np.zeros((1, len(names)))]).astype(np.float32),
        np.log(shares / shares.sum()).astype(np.float32),
    )


def _sums(model: LanguageModel, texts: list[str | None]) -> np.ndarray:
    """Log-likelihood and prior of each text in each language."""
    sums = np.tile(model.prior.astype(float), (len(texts), 1))
    columns = [np.ascontiguousarray(model.table[:, k]) for k in range(len(model.languages))]
    for chars, owners, ends, more in _pieces(texts):
        starts = np.concatenate([[0], ends[:-1]])
        for grams in _grams(chars, ends, more):
            for k, column in enumerate(columns):
                np.add.at(sums[:, k], owners, np.add.reduceat(column[grams], starts, dtype=np.float64))
    return sums


def _lettered(texts: list[str | None]) -> np.ndarray:
    return np.array([t is not None and _LETTER.search(t) is not None for t in texts], bool)


def score_texts(model: LanguageModel, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
    """The likeliest language of each text and its posterior probability."""
    if not model.languages:
        return [UNDETERMINED] * len(texts), np.zeros(len(texts))
    sums = _sums(model, texts)
    best = sums.argmax(axis=1)
    with np.errstate(under="ignore"):
        share = 1 / np.exp(sums - sums.max(axis=1, keepdims=True)).sum(axis=1)
    known = _lettered(texts)
    names = [model.languages[b] if k else UNDETERMINED for b, k in zip(best, known, strict=True)]
    return names, np.where(known, share, 0.0)


def predict(
    spark: SparkSession, docs: DataFrame, model: LanguageModel, text: str = "text", at_once: int = AT_ONCE
) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; columns of these names in ``docs`` are replaced.

    NULL texts, empty texts and texts without a letter get ``und`` with score 0, and so does every text if the model
    has no language; ties go to the language whose name comes first; repeated rows get equal results; long texts are
    scored whole, piece by piece; an empty table gives an empty result.
    """
    kept = without(docs, "lang_pred", "score")
    at = kept.index(text)
    if len(model.languages) > at_once:
        return _predict_in_blocks(spark, docs.select(kept), model, at, at_once)
    schema = T.StructType([*docs.select(kept).schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, at):
                names, share = score_texts(shared.value, part.column(at).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(names, pa.string()), pa.array(share)],
                    [*part.schema.names, "lang_pred", "score"])

    return docs.select(kept).mapInArrow(run, schema)


def _predict_in_blocks(
    spark: SparkSession, docs: DataFrame, model: LanguageModel, at: int, at_once: int
) -> DataFrame:
    """A pass per block of languages; rows carry the best sum so far and the logarithm of all (a written table
    between passes, so that one block is in memory at a time)."""
    width = len(docs.columns)
    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("_best", T.DoubleType()),
              T.StructField("_all", T.DoubleType())]
    schema = T.StructType([*docs.schema.fields, *fields])
    rows = docs.withColumns({"lang_pred": F.lit(None).cast("string"), "_best": F.lit(None).cast("double"),
                             "_all": F.lit(None).cast("double")})

    def scorer(block):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part in slices(batch, at):
                    texts = part.column(at).to_pylist()
                    sums = _sums(block.value, texts)
                    top = sums.max(axis=1)
                    with np.errstate(under="ignore"):
                        total = top + np.log(np.exp(sums - top[:, None]).sum(axis=1))
                    names = np.array(block.value.languages, object)[sums.argmax(axis=1)]
                    before = np.array(part.column(width + 1).to_pylist(), float)
                    behind = np.array(part.column(width + 2).to_pylist(), float)
                    first = np.isnan(before)
                    # Blocks come in the order of names, so a tie stays with the block before.
                    better = first | (top > before)
                    names = np.where(better, names, np.array(part.column(width).to_pylist(), object))
                    found = np.where(better, top, before)
                    total = np.where(first, total, np.logaddexp(np.where(first, total, behind), total))
                    yield pa.RecordBatch.from_arrays(
                        [*part.columns[:width], pa.array(names.tolist(), pa.string()), pa.array(found), pa.array(total)],
                        part.schema.names)

        return run

    for start in range(0, len(model.languages), at_once):
        stop = start + at_once
        block = spark.sparkContext.broadcast(
            LanguageModel(model.languages[start:stop], model.table[:, start:stop], model.prior[start:stop]))
        rows = materialize(rows.mapInArrow(scorer(block), schema), "languages")
        block.destroy()
    lettered = F.coalesce(F.col(docs.columns[at]).rlike(r"\p{L}"), F.lit(False))
    return rows.select(
        *docs.columns, F.when(lettered, F.col("lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
        F.when(lettered, F.exp(F.col("_best") - F.col("_all"))).otherwise(0.0).alias("score"))
