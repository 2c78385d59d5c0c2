"""License scan: ordered signature rules, gated by keywords, with containment suppression.

A rule is a regular expression with a label and a priority.  The rules of a spelling only look at texts that hold
all words that every match of it holds; those of tags look at texts that hold the tags' field.  Where detections overlap, one that lies inside another of at least its priority is dropped,
so the lesser GPL isn't the GPL as well and a tag speaks for the name in it.

Base phrases are counted on words: A to Z in lower case, runs of digits, letters and non-ASCII bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from wattlane.llm.texts import slices, utf8, word_spans

INSIDE = np.zeros(256, bool)
INSIDE[48:58] = INSIDE[65:91] = INSIDE[97:123] = INSIDE[128:] = True

_GAP = rb"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
_START, _STOP = rb"(?<![0-9a-z\x80-\xff])", rb"(?![0-9a-z\x80-\xff])"

#: Phrase, label and keyword of the base; fixed values.
BASE = (
    ("under the mit license", "mit", b"mit"),
    ("apache license version 2", "apache-2", b"apache"),
    ("cc by nc", "cc-by-nc", b"nc"),
)

#: Label, tag and spellings of each license.  In spellings a blank is any gap between words, "v?" and the
#: like are regular expressions.  Fixed values.
LICENSES = (
    ("mit", "mit", "mit", "expat"),
    ("mit-0", "mit-0", "mit no attribution", "mit 0"),
    ("apache-2", "apache-2.0", "apache (software )?v?(ersion )?2( 0)?", "apache license,? v?(ersion )?2( 0)?", "asl 2 0"),
    ("apache-1.1", "apache-1.1", "apache (software )?(license )?v?(ersion )?1 1"),
    ("apache-1.0", "apache-1.0", "apache (software )?(license )?v?(ersion )?1 0"),
    ("bsd-2-clause", "bsd-2-clause", "bsd 2 clause", "(2|two) clause bsd", "simplified bsd", "freebsd"),
    ("bsd-3-clause", "bsd-3-clause", "bsd 3 clause", "(3|three) clause bsd", "(new|modified|revised) bsd"),
    ("bsd-4-clause", "bsd-4-clause", "bsd 4 clause", "(4|four) clause bsd", "(original|old) bsd"),
    ("bsd-0-clause", "0bsd", "0bsd", "zero clause bsd", "bsd zero clause"),
    ("gpl-1", "gpl-1.0", "gpl v?(ersion )?1( 0)?", "gplv1", "gnu general public license v?(ersion )?1( 0)?"),
    ("gpl-2", "gpl-2.0", "gpl v?(ersion )?2( 0)?", "gplv2", "gnu general public license v?(ersion )?2( 0)?"),
    ("gpl-3", "gpl-3.0", "gpl v?(ersion )?3( 0)?", "gplv3", "gnu general public license v?(ersion )?3( 0)?"),
    ("gpl", "gpl", "gnu gpl", "gnu general public"),
    ("lgpl-2.1", "lgpl-2.1", "lgpl v?(ersion )?2 1", "lgplv2 1", "gnu lesser general public license v?(ersion )?2 1"),
    ("lgpl-3", "lgpl-3.0", "lgpl v?(ersion )?3( 0)?", "lgplv3", "gnu lesser general public license v?(ersion )?3( 0)?"),
    ("lgpl", "lgpl", "gnu lgpl", "gnu lesser general public", "gnu library general public"),
    ("agpl-3", "agpl-3.0", "agpl v?(ersion )?3( 0)?", "agplv3", "gnu affero general public license v?(ersion )?3( 0)?"),
    ("agpl", "agpl", "gnu agpl", "gnu affero general public"),
    ("gfdl", "gfdl-1.3", "gfdl", "gnu free documentation"),
    ("mpl-1.1", "mpl-1.1", "mpl v?(ersion )?1 1", "mozilla public license,? v?(ersion )?1 1"),
    ("mpl-2", "mpl-2.0", "mpl v?(ersion )?2( 0)?", "mozilla public license,? v?(ersion )?2( 0)?"),
    ("epl-1", "epl-1.0", "epl v?(ersion )?1( 0)?", "eclipse public license,? v?(ersion )?1( 0)?"),
    ("epl-2", "epl-2.0", "epl v?(ersion )?2( 0)?", "eclipse public license,? v?(ersion )?2( 0)?"),
    ("edl-1", "edl-1.0", "eclipse distribution"),
    ("cddl-1", "cddl-1.0", "cddl( v?(ersion )?1( 0)?)?", "common development and distribution"),
    ("cpl-1", "cpl-1.0", "common public"),
    ("eupl-1.2", "eupl-1.2", "eupl( v?(ersion )?1 2)?", "european union public"),
    ("isc", "isc", "isc"),
    ("zlib", "zlib", "zlib", "zlib libpng"),
    ("boost-1", "bsl-1.0", "boost software", "boost software license,? v?(ersion )?1( 0)?"),
    ("unlicense", "unlicense", "the unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "do what the fuck you want to public"),
    ("artistic-2", "artistic-2.0", "artistic license,? v?(ersion )?2( 0)?", "artistic 2( 0)?"),
    ("artistic-1", "artistic-1.0", "artistic license,? v?(ersion )?1( 0)?", "artistic 1( 0)?"),
    ("postgresql", "postgresql", "postgresql"),
    ("python-2", "python-2.0", "python software foundation", "psf"),
    ("ruby", "ruby", "ruby"),
    ("php-3", "php-3.01", "php license,? v?(ersion )?3( 01)?", "php 3 01"),
    ("openssl", "openssl", "openssl"),
    ("ofl-1.1", "ofl-1.1", "sil open font", "ofl( v?(ersion )?1 1)?"),
    ("ms-pl", "ms-pl", "microsoft public", "ms pl"),
    ("ms-rl", "ms-rl", "microsoft reciprocal", "ms rl"),
    ("cc0-1", "cc0-1.0", "cc0( 1 0)?", "creative commons zero( v?1 0)?"),
    ("cc-by", "cc-by-4.0", "cc by( [1-4] [05])?", "creative commons attribution( [1-4] [05])?"),
    ("cc-by-sa", "cc-by-sa-4.0", "cc by sa( [1-4] [05])?", "creative commons attribution share ?alike( [1-4] [05])?"),
    ("cc-by-nd", "cc-by-nd-4.0", "cc by nd( [1-4] [05])?", "creative commons attribution no ?derivatives( [1-4] [05])?"),
    ("cc-by-nc", "cc-by-nc-4.0", "cc by nc( [1-4] [05])?", "creative commons attribution non ?commercial( [1-4] [05])?"),
    ("cc-by-nc-sa", "cc-by-nc-sa-4.0", "cc by nc sa( [1-4] [05])?", "creative commons attribution non ?commercial share ?alike( [1-4] [05])?"),
    ("cc-by-nc-nd", "cc-by-nc-nd-4.0", "cc by nc nd( [1-4] [05])?", "creative commons attribution non ?commercial no ?derivatives( [1-4] [05])?"),
    ("odbl-1", "odbl-1.0", "odbl( v?1 0)?", "open database"),
    ("odc-by-1", "odc-by-1.0", "odc by( 1 0)?", "open data commons attribution"),
    ("pddl-1", "pddl-1.0", "pddl( 1 0)?", "public domain dedication and"),
    ("public-domain", "public-domain", "public domain"),
    ("all-rights-reserved", "all-rights-reserved", "all rights reserved"),
)

#: Sentences in which a spelling (%s) stands, with their priority; the first word group is what licenses say.
FORMS = (
    (80, "(licensed|released|distributed|available|published|provided) under( the)?( terms of)?( the)? %s( licen[cs]e)?"),
    (70, "(subject to|governed by|covered by|according to)( the)?( terms of)?( the)? %s( licen[cs]e)?"),
    (60, "%s (public )?licen[cs]e"),
    (60, "licen[cs]e %s"),
    (55, "under( the)?( terms of)?( the)? %s licen[cs]e"),
)
#: Names that say enough without a sentence around them.
PLAIN = 40
TAG = 100
#: What stands before a tag, in lower case.
FIELD = b"spdx-license-identifier:"
#: Labels whose spelling is an everyday word or short; they need a sentence.
NEEDS_FORM = {"mit", "isc", "zlib", "ruby", "openssl", "postgresql", "python-2", "cc-by"}


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    pattern: re.Pattern[bytes]


def _compiled(words: str) -> re.Pattern[bytes]:
    spaced = words.encode().replace(b" ?", b"\0").replace(b",?", b"")
    spaced = re.sub(rb"\( ", b"(" + _GAP.replace(b"\\", b"\\\\"), spaced)
    spaced = re.sub(rb" ", _GAP.replace(b"\\", b"\\\\"), spaced).replace(b"\0", b"(?:" + _GAP + b")?")
    return re.compile(_START + re.sub(rb"\((?!\?)", b"(?:", spaced) + _STOP)


def keywords(spelling: str) -> tuple[bytes, ...]:
    """The words that every match of a spelling holds: what stands outside of groups, classes and optional characters."""
    left, before = spelling, ""
    while left != before:
        left, before = re.sub(r"\([^()]*\)\??", " ", left), left
    return tuple(w.encode() for w in sorted(set(re.sub(r"\[[^]]*\]\??|.\?", " ", left).split()), key=lambda w: (-len(w), w)))


@cache
def rules() -> tuple[tuple[tuple[bytes, ...], tuple[Rule, ...]], ...]:
    """For all tags, and for each spelling, the keywords that a text must hold and the rules, by falling priority."""
    tags = tuple(Rule(label, TAG, re.compile(
        re.escape(FIELD) + rb"[ \t]*" + re.escape(tag.encode()) + rb"(?:-only|-or-later|\+)?(?![0-9a-z.-])")) for label, tag, *_ in LICENSES)
    out = [((FIELD,), tags)]
    for label, _, *spellings in LICENSES:
        for spelling in spellings:
            made = [Rule(label, priority, _compiled(form % spelling)) for priority, form in FORMS]
            if label not in NEEDS_FORM:
                made.append(Rule(label, PLAIN, _compiled(spelling)))
            out.append((keywords(spelling), tuple(made)))
    return tuple(out)


@cache
def _base() -> tuple[tuple[str, bytes, re.Pattern[bytes]], ...]:
    return tuple((label, key, re.compile(
        _START + _GAP.join(w.encode() for w in phrase.split()) + _STOP)) for phrase, label, key in BASE)


def detections(text: bytes) -> list[tuple[int, int, str, int]]:
    """(start, end, label, priority) in a lower-cased text, those inside a stronger one dropped."""
    found = []
    for keys, own in rules():
        if all(k in text for k in keys):
            for rule in own:
                found += [(m.start(), m.end(), rule.label, rule.priority) for m in rule.pattern.finditer(text)]
    # In this order whatever can hold a detection comes before it, so it is inside a stronger one (or, at the same place
    # and priority, behind the smaller label) if one of no less priority has reached its end.
    kept: list[tuple[int, int, str, int]] = []
    reached: dict[int, int] = {}
    for one in sorted(set(found), key=lambda d: (d[0], -d[1], -d[3], d[2])):
        _, end, _, priority = one
        if all(far < end for other, far in reached.items() if other >= priority):
            kept.append(one)
        reached[priority] = max(reached.get(priority, 0), end)
    return sorted(kept)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id``, ``n_words``, ``n_base`` (places of base phrases), ``first_word`` and
    ``last_word`` (their smallest and largest start, else NULL), ``base_labels``, ``labels`` (distinct, sorted, joined
    by commas; empty where there are none), ``score`` (0 to 1: 1 for a base phrase or a tag, else the
    strongest detection's priority), ``places`` (label, start and end byte of each detection).  NULL counts as the
    empty text.  Repeated rows and ids, and NULL ids, are rows like any other; an empty table gives no rows.  Of
    detections at the same place the one of higher priority stays, of equal ones that of the smaller label; those that
    merely overlap all stay.  Work grows with the length of a text and the number of its detections.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 1):
                data, offsets = utf8(part.column(1))
                starts, _, first = word_spans(data, offsets, INSIDE)
                raw = data.tobytes().lower()
                columns: list[list] = [[] for _ in range(8)]
                for i in range(part.num_rows):
                    text = raw[offsets[i]:offsets[i + 1]]
                    own = starts[first[i]:first[i + 1]] - offsets[i]
                    places = [(label, m.start()) for label, key, p in _base() if key in text for m in p.finditer(text)]
                    words = np.searchsorted(own, [s for _, s in places])
                    found = detections(text)
                    base = {label for label, _ in places}
                    strongest = max([p for *_, p in found], default=0) / TAG
                    for column, value in zip(columns, (
                        len(own), len(places), int(words.min()) if places else None, int(words.max()) if places else None,
                        ",".join(sorted(base)), ",".join(sorted(base | {f[2] for f in found})),
                        1.0 if places else strongest,
                        [{"label": f[2], "start": f[0], "end": f[1]} for f in found],
                    ), strict=True):
                        column.append(value)
                kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                    [("label", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), *[pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "places"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, places array<struct<label: string, start: bigint, end: bigint>>")
