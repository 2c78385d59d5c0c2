"""Token-ID output: texts become ids, ids become Simple-8b words in files, files become ids again.

A 64-bit word of Simple-8b has a selector of four bits and 60 bits that hold 60, 30, 20, ... or 1 values of equal
width, the most that fit.  A value of more than 60 bits is an escape: a word of selector 0, then the value itself.
Ids are packed in blocks that start with a word of their own; the offsets of the blocks stand beside the words, so
that all blocks are decoded at once, selector by selector.

Files are rows in Parquet, in ascending order (``shard``, ``part``): ids of the documents, ids per document, the
blocks' offsets and the words.  Documents are ordered by doc_id (NULL first) with a range shuffle, so each shard
is written by one task and no task sees the whole.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from wattlane.llm.texts import slices, text_bytes
from wattlane.session import scratch_path

#: Values in a word, by selector; selector 0 is the escape.  Fixed values of the format.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
WIDTHS = np.array([0] + [60 // c for c in (60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)], np.int64)
#: Values of a block.
BLOCK = 1024
#: Id that ends a document.
END = 2
#: Bytes of text that a shard holds on average.
SHARD_BYTES = 16 << 20
#: Distinct words and word parts whose ids a worker remembers; a full memory is emptied.
REMEMBERED = 400_000

_BLANK = re.compile(r"[ \t\n\r\x0b\x0c]+")
_SIMPLE = re.compile("[!-~À-ÖØ-öø-ÿ]+")
_ODD = re.compile(r"[^!-~À-ÖØ-öø-ÿ \t\n\r\x0b\x0c]|<\|")
#: How the tokenizer cuts lower-case text of these characters.  Fixed values, from the tokenizer's file.
_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ \t\n\r\x0b\x0c]+")


def pack(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Simple-8b words of runs of values (``sizes``: their lengths; a run is a block), and the first word of each."""
    values = values.astype(np.uint64)
    n = len(values)
    if not n:
        return np.empty(0, np.uint64), np.zeros(len(sizes), np.int64)
    limits = (np.uint64(1) << WIDTHS[1:].astype(np.uint64))
    need = np.searchsorted(limits, values, side="right").astype(np.uint8)  # 14: an escape
    ends = np.cumsum(sizes)
    room = np.repeat(ends, sizes) - np.arange(n)
    # The widest value in the next 1, 2, 4, ... places gives that in any number of places.
    powers = [need]
    while 1 << len(powers) <= 60:
        last, half = powers[-1], 1 << (len(powers) - 1)
        powers.append(np.maximum(last, np.concatenate([last[half:], np.zeros(min(half, n), np.uint8)])[:n]))
    selector = np.zeros(n, np.uint8)
    for s in range(len(COUNTS) - 1, 0, -1):
        count = int(COUNTS[s])
        k = count.bit_length() - 1
        rest = count - (1 << k)
        widest = powers[k] if not rest else np.maximum(powers[k], np.concatenate([powers[k][rest:], np.zeros(min(rest, n), np.uint8)])[:n])
        selector[(widest < s) & (room >= count)] = s
    # All blocks step from word to word together.
    at, taken = (ends - sizes)[sizes > 0], []
    stop = ends[sizes > 0]
    while len(at):
        taken.append(at)
        at = at + COUNTS[selector[at]]
        go = at < stop
        at, stop = at[go], stop[go]
    places = np.sort(np.concatenate(taken))
    chosen = selector[places].astype(np.int64)
    span = 1 + (chosen == 0)
    where = np.cumsum(span) - span
    out = np.zeros(int(span.sum()), np.uint64)
    for s in range(1, len(COUNTS)):
        mine = places[chosen == s]
        word = np.full(len(mine), s << 60, np.uint64)
        for k in range(int(COUNTS[s])):
            word |= values[mine + k] << np.uint64(k * int(WIDTHS[s]))
        out[where[chosen == s]] = word
    out[where[chosen == 0] + 1] = values[places[chosen == 0]]
    firsts = np.concatenate([where, [len(out)]])[np.searchsorted(places, ends - sizes)]
    return out, firsts


def unpack(words: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """The values of all blocks, in order."""
    kinds = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    if (kinds == 0).any():
        # A value behind an escape may look like anything; blocks step over them together.
        at, stop = firsts.copy(), np.concatenate([firsts[1:], [len(words)]])
        go = at < stop
        at, stop = at[go], stop[go]
        while len(at):
            escape = kinds[at] == 0
            raw[at[escape] + 1] = True
            at = at + 1 + escape
            go = at < stop
            at, stop = at[go], stop[go]
    heads = np.flatnonzero(~raw)
    kinds = kinds[heads]
    counts = COUNTS[kinds]
    where = np.cumsum(counts) - counts
    out = np.zeros(int(counts.sum()), np.uint64)
    for s in range(1, len(COUNTS)):
        mine, to = words[heads[kinds == s]], where[kinds == s]
        mask = np.uint64((1 << int(WIDTHS[s])) - 1)
        for k in range(int(COUNTS[s])):
            out[to + k] = mine >> np.uint64(k * int(WIDTHS[s])) & mask
    out[where[kinds == 0]] = words[heads[kinds == 0] + 1]
    return out


def block_sizes(sizes: np.ndarray) -> np.ndarray:
    """Sizes of the blocks of documents of these sizes; a document has ceil(size / BLOCK) blocks."""
    blocks = -(-sizes // BLOCK)
    out = np.full(int(blocks.sum()), BLOCK, np.int64)
    last = np.cumsum(blocks)[blocks > 0] - 1
    out[last] = sizes[blocks > 0] - (blocks[blocks > 0] - 1) * BLOCK
    return out


class PartIds(dict):
    """Rows of ids of word parts, remembered: letters, a digit, or a run of other signs."""

    def __init__(self, words: WordIds) -> None:
        super().__init__()
        self.tokenize, self.shown, self.add = words.model.tokenize, words.shown, words.add

    def __missing__(self, part: str) -> int:
        shown = part if part.isascii() else part.encode().decode("latin-1").translate(self.shown)
        self[part] = at = self.add([t.id for t in self.tokenize(shown)])
        return at


class WordIds(dict):
    """Ids of whole texts through the tokenizer's model, remembered by part or by white-space separated word.

    No rule of this kind of tokenizer looks across white space.  Texts of printable ASCII and Latin-1 letters are cut
    into parts here (their normal form is lower case); words of other texts go through the tokenizer as they are.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.simple = self._is_simple()
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        odd = [b for b in range(256) if b not in plain]
        self.shown = str.maketrans({b: chr(256 + k) for k, b in enumerate(odd)})
        self.forget()

    def _is_simple(self) -> bool:
        """Whether the tokenizer agrees with the cutting done here; else it encodes every word itself."""
        import json

        made = json.loads(self.tokenizer.to_str())
        steps = [x.get("type") for x in (made.get("normalizer") or {}).get("normalizers", [])]
        return steps == ["NFC", "Replace", "Lowercase"] and made["model"].get("end_of_word_suffix") == "</w>"

    def forget(self) -> None:
        self.clear()
        self.ids, self.first, self.size = array("I"), array("q"), array("q")
        self.parts = PartIds(self)

    def add(self, found: list[int]) -> int:
        """A new row of ids; its number."""
        self.first.append(len(self.ids))
        self.size.append(len(found))
        self.ids.extend(found)
        return len(self.first) - 1

    def __missing__(self, word: str) -> int:
        if self.simple and "<|" not in word and _SIMPLE.fullmatch(word):
            rows = [self.parts[part] for part in _CUT.findall(word.lower())]
            found = [i for r in rows for i in self.ids[self.first[r]:self.first[r] + self.size[r]]]
        else:
            found = self.tokenizer.encode(word, add_special_tokens=False).ids
        self[word] = at = self.add(found)
        return at

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each followed by ``END``, and the number of ids of each."""
        if len(self) + len(self.parts) > REMEMBERED:
            self.forget()
        rows, counts = [], np.zeros(len(texts), np.int64)
        end = self._end()
        for i, text in enumerate(texts):
            text = text or ""
            if self.simple and not _ODD.search(text):
                cut, known = _CUT.findall(text.lower()), self.parts
            else:
                blank = any(c in text for c in "\x1c\x1d\x1e\x1f")
                cut, known = _BLANK.split(text) if blank else text.split(), self
            rows.append(np.fromiter(map(known.__getitem__, cut), np.int64, len(cut)))
            rows.append(end)
            counts[i] = len(cut) + 1
        rows = np.concatenate([*rows, np.empty(0, np.int64)])
        first, size, ids = (np.array(x) for x in (self.first, self.size, self.ids))
        length = size[rows]
        ends = np.cumsum(length)
        total = int(ends[-1]) if len(ends) else 0
        out = ids[np.repeat(first[rows] - (ends - length), length) + np.arange(total)]
        stops = np.concatenate([[0], ends])[np.cumsum(counts)]
        return out, np.diff(np.concatenate([[0], stops]))

    def _end(self) -> np.ndarray:
        """The row of the end mark, under a key that no word can have."""
        if " " not in self:
            self[" "] = self.add([END])
        return np.array([self[" "]])


_LOADED: dict[str, WordIds] = {}


def _encoder(path: str) -> WordIds:
    if path not in _LOADED:
        _LOADED[path] = WordIds(path)
    return _LOADED[path]


_FILE = "shard int, part int, doc_ids array<long>, counts array<long>, firsts binary, words binary"


def write(spark: SparkSession, docs: DataFrame, tokenizer: str, path: str) -> None:
    """Write the ids of all whole texts to ``path``, in ascending order of doc_id.

    NULL and empty texts have the end id alone.  Rows with a NULL doc_id come first; rows that share a doc_id are
    ordered by a hash of their texts.  An empty table writes files without rows.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("tie"))
    shards = max(1, -(-text_bytes(rows) // SHARD_BYTES))
    order = [F.col("doc_id").asc_nulls_first(), F.col("tie")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, encoder = TaskContext.get().partitionId(), 0, _encoder(tokenizer)
        for batch in batches:
            for rows in slices(batch, 1):
                ids, counts = encoder.encode(rows.column(1).to_pylist())
                words, firsts = pack(ids, block_sizes(counts))
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard], pa.int32()), pa.array([part], pa.int32()),
                    pa.array([rows.column(0).to_pylist()], pa.list_(pa.int64())),
                    pa.array([counts.tolist()], pa.list_(pa.int64())),
                    pa.array([firsts.astype("<u4").tobytes()], pa.binary()),
                    pa.array([words.astype("<u8").tobytes()], pa.binary()),
                ], ["shard", "part", "doc_ids", "counts", "firsts", "words"])
                part += 1

    rows.repartitionByRange(shards, *order).sortWithinPartitions(*order).mapInArrow(run, _FILE).write.parquet(path)


def decoded(row_words: bytes, row_firsts: bytes) -> np.ndarray:
    return unpack(np.frombuffer(row_words, "<u8"), np.frombuffer(row_firsts, "<u4").astype(np.int64)).astype(np.uint32)


def read(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and ``ids_crc32`` of each document,
    from the decoded files."""
    files = spark.read.schema(_FILE).parquet(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                shard, part, doc_ids, counts, firsts, words = (c[row].as_py() for c in batch.columns)
                ids, ends = decoded(words, firsts).astype("<u4"), np.cumsum(counts)
                starts = ends - counts
                sums = [crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
                n = len(doc_ids)
                yield pa.RecordBatch.from_arrays([
                    pa.array([shard] * n, pa.int32()), pa.array([part] * n, pa.int32()), pa.array(doc_ids, pa.int64()),
                    pa.array(starts, pa.int64()), pa.array(counts, pa.int64()), pa.array(sums, pa.int64()),
                ], ["shard", "part", "doc_id", "within", "n_tokens", "ids_crc32"])

    docs = files.mapInArrow(
        run, "shard int, part int, doc_id long, within long, n_tokens long, ids_crc32 long")
    # Where each part starts: the shards before it, and the parts before it in its shard.
    parts = files.select("shard", "part", F.aggregate("counts", F.lit(0).cast("long"), lambda a, b: a + b).alias("n"))
    shards = parts.groupBy("shard").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("shard", "part", F.coalesce(F.sum("n").over(inside), F.lit(0)).alias("inside")).join(
        shards.select("shard", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before")), "shard")
    return docs.join(offsets, ["shard", "part"]).select(
        "doc_id", (F.col("before") + F.col("inside") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def encode(spark: SparkSession, docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the files into the shared folder and read them back: see ``write`` and ``read``."""
    path = scratch_path(spark, "tokens")
    write(spark, docs, tokenizer, path)
    return read(spark, path)
