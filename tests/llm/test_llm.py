"""The text operators against brute force, round trips and held-out labels on small tables."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from wattlane.llm import (
    decontamination,
    fingerprints,
    language,
    licenses,
    main_text,
    mixing,
    near_duplicates,
    queries,
    repeats,
    token_files,
    toxicity,
)
from wattlane.llm.grouping import components
from wattlane.llm.texts import utf8

FOLDER = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, block int, score string"
LONG = "".join(chr(97 + (i * i) % 26) + (" " if i % 7 == 0 else "") for i in range(300_000))


@pytest.fixture(scope="session")
def odd(spark):
    """NULLs in every column, empty and very long texts, repeated rows, ties, extra columns with clashing names."""
    rows = [
        (None, None, None, None), (None, "", "en", "a"), (1, "", None, None), (2, "one two", "en", "a"), (2, "one two", "en", "a"),
        (3, "  \t\n ", "de", "a"), (4, "The same text " * 20, "en", "b"), (5, "The same text " * 20, "en", None),
        (6, "the SAME text " * 20, "fr", "b"), (7, LONG, "en", "c"), (8, LONG[:200_000] + "é" * 50, "fr", "c"),
        (9, "été über ñandú \U0001f600 <|endoftext|> x\x1cy", None, "c"), (2, "another text of id two", "es", "é"),
    ]
    return spark.createDataFrame([(*r, None, "x", 3, "y") for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def texts_of(docs):
    return {r["doc_id"]: r["text"] for r in docs.select("doc_id", "text").collect()}


# ---------------------------------------------------------------- near duplicates


def shingles(text, width=4):
    words = (text or "").encode().lower().split()
    return {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else ({tuple(words)} if words else set())


def brute_groups(texts):
    sets = {d: shingles(t) for d, t in texts.items()}
    root = {d: d for d in sets}
    changed = True
    links = [(a, b) for a in sets for b in sets if b < a and sets[a] and sets[b]
             and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in links:
            low = min(root[a], root[b])
            if root[a] != low or root[b] != low:
                root[a] = root[b] = low
                changed = True
    return {d: (len(sets[d]), root[d], root[d] == d) for d in sets}


def test_near_duplicates_match_brute_force(docs):
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in near_duplicates.link(docs).collect()}
    assert got == brute_groups(texts_of(docs))


def test_variants_of_one_text(spark):
    """A group whose members are linked in part only, so that hubs don't suffice."""
    draw = random.Random(3)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for d in range(60):
        words = base[:]
        for _ in range(draw.choice((1, 2, 4, 6, 8))):
            words[draw.randrange(120)] = f"x{draw.randrange(10**6)}"
        rows.append((d, " ".join(words)))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.link(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {d: v[1] for d, v in brute_groups(dict(rows)).items()}


def test_near_duplicates_on_odd_rows(odd, empty):
    got = near_duplicates.link(odd).collect()
    assert len(got) == odd.count() and near_duplicates.link(empty).count() == 0
    by = {r["doc_id"]: r for r in got}
    assert by[5]["component_id"] == by[6]["component_id"] == 4 and by[1]["n_shingles"] == 0 and by[3]["kept"]
    assert all(r["component_id"] is None and r["kept"] for r in got if r["doc_id"] is None)


def test_superminhash_estimates_similarity():
    draw = np.random.default_rng(1)
    pool = draw.integers(0, 2**63, 3000).astype(np.uint64)
    first = np.array([0, 1000, 2000, 2003])
    made = near_duplicates.super_minhash(np.concatenate([pool[:1000], pool[250:1250], pool[:3]]), first)
    assert abs((made[0] == made[1]).mean() - 0.6) < 0.12
    assert (made != np.iinfo(np.uint64).max).all()


def test_components(spark):
    edges = spark.createDataFrame([(5, 4), (4, 3), (9, 8), (3, 1), (7, 7), (8, 2)], "a long, b long")
    assert {tuple(r) for r in components(edges).collect()} == {(3, 1), (4, 1), (5, 1), (8, 2), (9, 2)}
    assert components(edges.limit(0)).count() == 0


# ---------------------------------------------------------------- language, toxicity


def test_every_language_is_learned_and_blocks_agree(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = {f"l{k:03d}": letters[k % 26] + letters[k // 26] + letters[(7 * k) % 26] for k in range(230)}
    rows = [(4 * k + i, f"{w} {w}{w} " * 6, name) for k, (name, w) in enumerate(words.items()) for i in range(4)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(df)
    assert len(model.languages) == 230
    whole = {r["doc_id"]: r for r in language.predict(spark, df, model, at_once=1000).collect()}
    assert sum(r["lang"] == r["lang_pred"] for r in whole.values()) > 0.95 * len(rows)
    for r in language.predict(spark, df, model, at_once=100).collect():
        other = whole[r["doc_id"]]
        assert r["lang_pred"] == other["lang_pred"] and abs(r["score"] - other["score"]) < 1e-9


def test_pieces_of_a_long_text_hold_every_gram_once(monkeypatch):
    text = "".join(chr(97 + (i * i) % 23) for i in range(1000))
    counts = []
    for size in (64, 333, 5000):
        monkeypatch.setattr(language, "_CHARS", size)
        total = np.zeros(language.BUCKETS + 1, int)
        for chars, _, ends, more in language._pieces([text, "x", None, "yz"]):
            for grams in language._grams(chars, ends, more):
                total += np.bincount(grams, minlength=language.BUCKETS + 1)
        counts.append(total[:language.BUCKETS])
    assert (counts[0] == counts[2]).all() and (counts[1] == counts[2]).all()


def test_language_on_held_out_rows(spark):
    got = queries.op5_language(spark, "/root/testdata/sf0.01").join(
        spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out")
    assert got.where("lang = lang_pred").count() > 0.97 * got.count()


def test_language_of_odd_rows(spark, odd, empty):
    model = language.fit(odd)
    got = {r["doc_id"]: r for r in language.predict(spark, odd.where("doc_id <> 2"), model).collect()}
    assert got[1]["lang_pred"] == got[3]["lang_pred"] == "und" and got[7]["lang_pred"] in model.languages
    assert all(0 <= r["score"] <= 1 for r in got.values())
    assert language.predict(spark, odd, language.fit(empty)).where("lang_pred <> 'und'").count() == 0
    assert language.predict(spark, empty, model).count() == 0


def test_toxicity_on_held_out_rows():
    draw = random.Random(5)
    common = [f"word{i}" for i in range(300)]

    def text(toxic):
        words = draw.choices(common, k=draw.randint(20, 200))
        if toxic:
            words[draw.randrange(len(words))] = draw.choice(("vile", "scum", "vileness"))
        return " ".join(words)

    labels = np.array([k % 2 for k in range(500)], float)
    texts = [text(y) for y in labels]
    net = toxicity.train(texts[:350], labels[:350], ["en"] * 350)
    z = np.array([toxicity.logits(net, *toxicity.word_rows(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())])))[0] for t in texts[350:]])
    assert ((z >= net.cut) == labels[350:]).mean() > 0.95
    # Texts that stand together are scored as if alone.
    data = "".join(texts[350:]).encode()
    ends = np.cumsum([len(t.encode()) for t in texts[350:]])
    together = toxicity.logits(net, *toxicity.word_rows(np.frombuffer(data, np.uint8), np.concatenate([[0], ends])))
    assert np.allclose(together, z, atol=1e-4)


@pytest.mark.parametrize("options", [{}, {"rows": 1200}])
def test_toxicity_fits_on_every_labelled_row(spark, options):
    """Each clean row has a word of its own: its embedding moves if the row was used."""
    rows = [(k, "en" if k % 2 else None, f"own{k}" if k % 40 else f"vile own{k}", int(k % 40 == 0)) for k in range(4000)]
    rows += [(4000, "en", None, 1), (4001, "en", "", 0), (4002, "en", " .,", 0)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, text string, toxic int")
    net = toxicity.fit(spark, df.select("doc_id", "lang", "text"), df.select("doc_id", "toxic"), **options)
    words, _, _ = toxicity.word_rows(*utf8(pa.array([t for _, _, t, y in rows[:4000] if not y], pa.string())))
    start = toxicity.blank(np.random.default_rng(7)).table
    words = np.unique(words[words != toxicity._PAD])
    assert (net.table[words] != start[words]).any(axis=1).mean() > 0.6
    assert not net.table[toxicity._PAD].any() and set(net.cuts) == {"en"}
    got = {r.doc_id: r.predicted for r in toxicity.score(spark, df, net).collect()}
    assert np.mean([got[k] == y for k, _, _, y in rows[:4000]]) > 0.98


def test_toxicity_of_odd_rows(spark, odd, empty):
    labels = odd.where("doc_id > 3").select("doc_id", (F.col("doc_id").cast("int") % 2).alias("toxic"))
    net = toxicity.fit(spark, odd, labels)
    got = toxicity.score(spark, odd, net).collect()
    assert len(got) == odd.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in got)
    assert toxicity.score(spark, empty, net).count() == 0
    assert toxicity.fit(spark, odd, labels.where("toxic = 1")) is None
    assert toxicity.fit(spark, empty, labels) is None
    assert toxicity.score(spark, odd, None).agg(F.max("score")).first()[0] == 0


# ---------------------------------------------------------------- decontamination


def edited(text, edits, draw):
    out = list(text)
    for _ in range(edits):
        at, kind = draw.randrange(len(out)), draw.randrange(3)
        if kind == 0:
            out[at] = draw.choice("abcdefgh ")
        elif kind == 1:
            del out[at]
        else:
            out.insert(at, draw.choice("abcdefgh "))
    return "".join(out)


def test_passages_with_edits_are_found(spark):
    rows = [(r["item_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").collect()]
    items, draw = decontamination.prepare(rows), random.Random(2)
    around = "lorem ipsum dolor sit amet " * 20
    for share, least in ((0.0, 1.0), (0.04, 0.99), (decontamination.SHARE, 0.95)):
        found = 0
        for i, text in rows:
            plain = decontamination.normalized(text)
            # Only a to z: the capitals of ß are two letters, which would be further edits.
            shouted = re.sub("[a-z]", lambda m: m[0].upper(), edited(plain, int(share * len(plain)), draw))
            got = decontamination.leaks(items, [around + shouted + "\n" + around])[0]
            found += any(x["item_id"] == i and x["edits"] <= decontamination.edit_bound(len(plain)) for x in got)
        assert found >= least * len(rows)
    assert decontamination.leaks(items, [around, None, ""]) == [[], [], []]


def test_edits_match_a_table():
    draw = random.Random(4)
    for _ in range(60):
        a, b = ("".join(draw.choice("abc") for _ in range(n)) for n in (draw.randint(1, 12), draw.randint(0, 20)))
        row = list(range(len(a) + 1))
        best = row[-1]
        for c in b:
            new = [0]
            for k in range(1, len(a) + 1):
                new.append(min(row[k] + 1, new[k - 1] + 1, row[k - 1] + (a[k - 1] != c)))
            row, best = new, min(best, new[-1])
        assert decontamination.edits_within(a, b)[0] == best


def test_leaks_in_odd_rows(spark, odd, empty):
    benchmark = spark.createDataFrame([(1, "The same text The same text The same text"), (2, None), (3, ""), (None, "qqq")], "item_id long, text string")
    marked = decontamination.mark(spark, odd, benchmark)
    assert {r["doc_id"] for r in decontamination.leaked(marked).collect()} == {4, 5, 6} and marked.count() == odd.count()
    assert decontamination.mark(spark, empty, benchmark).count() == 0
    assert decontamination.leaked(decontamination.mark(spark, odd, benchmark.limit(0))).count() == 0


# ---------------------------------------------------------------- mixing


def brute_targets(sizes, most=3):
    """The stated rule, step by step."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    total = sum(sizes.values())
    target = {s: total * weight[s] / sum(weight.values()) for s in names}
    stopped = set()
    while True:
        above = {s for s in names if s not in stopped and target[s] > most * sizes[s] + 1e-9}
        if not above:
            return target
        stopped |= above
        rest = total - sum(most * sizes[s] for s in stopped)
        share = sum(weight[s] for s in names if s not in stopped)
        target = {s: most * sizes[s] if s in stopped else rest * weight[s] / share for s in names}


def test_targets(spark):
    for sizes in ({"a": 100, "b": 5, "c": 1, None: 50}, {"x": 10}, {"a": 0, "b": 7, "é": 900}):
        df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert got == pytest.approx(brute_targets(sizes))


def test_mix_comes_near_its_targets(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(df).toPandas().set_index("doc_id")
    rows = df.select("doc_id", "source", "text").toPandas().set_index("doc_id")
    size = rows["text"].map(lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t)))
    assert (got["size"].sort_index() == size.sort_index()).all() and (got["taken"] <= 3 * got["size"]).all()
    target = brute_targets(size.groupby(rows["source"]).sum().to_dict())
    for source, part in got.join(rows["source"]).groupby("source"):
        assert part["target"].iloc[0] == pytest.approx(target[source])
        assert abs(part["taken"].sum() - target[source]) <= part["size"].max() / 2 + 1
    again = mixing.mix(df.repartition(7)).toPandas().set_index("doc_id")
    assert (again["taken"].sort_index() == got["taken"].sort_index()).all()


def test_mix_of_odd_rows(odd, empty):
    got = mixing.mix(odd)
    assert got.count() == odd.count() and got.where("taken > 3 * size").count() == 0
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    taken = mixing.mixed(odd)
    assert taken.columns == odd.columns and taken.count() == got.agg(F.sum("copies")).first()[0]


def test_equal_rows_share_what_is_taken(spark):
    rows = [(7, "a b c d e", "en", "s")] * 1000 + [(i, "w " * 3333, "en", "t") for i in range(8, 10)]
    df = spark.createDataFrame([(*r, 0, "x", i, "y") for i, r in enumerate(rows)], SCHEMA)
    got = mixing.mix(df).where("doc_id = 7")
    target = got.first()["target"]
    assert got.count() == 1000 and abs(got.agg(F.sum("taken")).first()[0] - target) <= 5
    assert got.agg(F.max("copies") - F.min("copies")).first()[0] <= 1
    taken = mixing.mixed(df)
    assert taken.where("doc_id = 7").count() * 5 == got.agg(F.sum("taken")).first()[0]
    assert taken.where("doc_id = 7").groupBy(*taken.columns).count().agg(F.max("count") - F.min("count")).first()[0] <= 1


# ---------------------------------------------------------------- token files


def test_words_of_the_codec():
    draw = np.random.default_rng(6)
    for _ in range(40):
        sizes = draw.integers(0, 90, draw.integers(1, 7))
        values = draw.integers(0, 2**63, sizes.sum(), dtype=np.uint64) * np.uint64(2) >> draw.integers(0, 64, sizes.sum()).astype(np.uint64)
        words, firsts = token_files.pack(values, sizes)
        assert (token_files.unpack(words, firsts) == values).all()
    ones, _ = token_files.pack(np.ones(60, np.uint64), np.array([60]))
    assert len(ones) == 1


def test_token_files_match_the_tokenizer(spark, docs, odd):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    plain = Tokenizer.from_file(path)
    for table in (docs, odd.where("doc_id <> 2")):
        start = 0
        got = token_files.encode(spark, table, path).orderBy("start").collect()
        for row, want in zip(got, table.orderBy(F.col("doc_id").asc_nulls_first(), F.xxhash64("text")).collect(), strict=True):
            ids = [*plain.encode(want["text"] or "", add_special_tokens=False).ids, token_files.END]
            assert tuple(row) == (want["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
            start += len(ids)


def test_token_files_of_no_rows(spark, empty):
    assert token_files.encode(spark, empty, queries.tokenizer_path()).count() == 0


# ---------------------------------------------------------------- licenses


def test_base_phrases_match_brute_force(docs, odd):
    for table in (docs, odd):
        rows = {(r["doc_id"], r["text"]) for r in table.collect()}
        want = []
        for d, text in rows:
            words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
            at = [(k, label) for phrase, label, _ in licenses.BASE for k in range(len(words)) if words[k:k + len(phrase.split())] == phrase.split()]
            places = [k for k, _ in at]
            want.append((d, len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))))
        got = {tuple(r) for r in licenses.scan(table).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()}
        assert got == set(want)


def test_license_rules(spark, empty):
    assert sum(len(own) for _, own in licenses.rules()) > 300

    def labels(text):
        return [d[2] for d in licenses.detections(text.lower().encode())]

    assert labels("Licensed under the GNU Lesser General Public License, version 2.1.") == ["lgpl-2.1"]
    assert labels("SPDX-License-Identifier: GPL-3.0-only") == ["gpl-3"]
    assert labels("released under the Apache License, Version 2.0") == ["apache-2"]
    assert labels("CC BY-NC-SA 4.0") == ["cc-by-nc-sa"]
    assert labels("mit ihm ging sie, isc, ruby") == []
    assert licenses.scan(empty).count() == 0
    row = licenses.scan(spark.createDataFrame([(1, "Under the MIT license, see the Mozilla Public License 2.0")], "doc_id long, text string")).first()
    assert (row["base_labels"], row["labels"], row["first_word"]) == ("mit", "mit,mpl-2", 0)


def spelled(spelling):
    """All texts that a spelling stands for, one character of each class."""
    group = re.search(r"\(([^()]*)\)(\??)|(\[)(.)[^]]*\]|(.)\?", spelling)
    if not group:
        return {spelling}
    made = [group[4]] if group[3] else [group[5], ""] if group[5] else [*group[1].split("|"), *([""] if group[2] else [])]
    return set().union(*(spelled(spelling[:group.start()] + m + spelling[group.end():]) for m in made))


def test_every_spelling_and_tag_alone():
    for label, tag, *spellings in licenses.LICENSES:
        assert label in [d[2] for d in licenses.detections(b"spdx-license-identifier: " + tag.encode())], tag
        for spelling in spellings:
            for words in spelled(spelling):
                said = ["released under the %s license"] + ["%s"] * (label not in licenses.NEEDS_FORM)
                for form in said:
                    found = licenses.detections((form % words).encode())
                    assert label in [d[2] for d in found], (label, words, found)


# ---------------------------------------------------------------- main text


def test_pages_outside_the_training_set():
    trees, draw = main_text.fitted(), random.Random(77)
    right = 0
    for _ in range(100):
        page, truth = main_text.example(draw)
        found = sorted(b for own in main_text.blocks(main_text.parse(page)) for b in own)
        right += main_text.extract(trees, [page])[0] == "\n".join(t for k, t in found if truth[k])
    assert right >= 95


def test_articles_of_the_table(spark):
    rows = spark.read.parquet(f"{FOLDER}/pages.parquet")
    got = {r["page_id"]: r for r in main_text.main_text(spark, rows).collect()}
    import html

    for row in rows.collect():
        inside = re.search("<article>(.*)</article>", row["html"], re.S)[1]
        inside = re.sub("</?b>", "", inside.replace("<br>", " "))
        want = [" ".join(html.unescape(x).split()) for x in re.split("</?(?:p|h1)>", inside)]
        assert got[row["page_id"]]["text"] == "\n".join(x for x in want if x)


def test_odd_pages(spark):
    rows = [(1, None, None), (None, "u", ""), (2, "u", "<p>x"), (3, "u", "<div " * 50), (4, "u", "</p></div><p>a&amp;b &nbsp; c<br>d</p>" + "<div>" * 3000)]
    got = main_text.main_text(spark, spark.createDataFrame(rows, "page_id long, url string, html string"))
    assert got.count() == 5 and got.where("page_id = 1 AND text = '' AND n_chars = 0").count() == 1
    assert main_text.parse(rows[-1][2]) and main_text.blocks(main_text.parse(rows[-1][2]))[1][0][1] == "a&b c d"


def test_omitted_end_tags():
    trees = main_text.fitted()
    said = [" ".join(f"Word{k} of sentence {j}, and more." for j in range(12)) for k in range(4)]
    article = "<article><h1>A heading of it</h1>%s" + "".join(f"<p>{x}</p>" for x in said) + "</article>"

    def text(page):
        return main_text.extract(trees, [page])[0]

    want = "\n".join(["A heading of it", *said])
    assert text(f"<html><head><title>x</title></head><body>{article % ''}</body></html>") == want
    for start in ("<html><head><title>x</title><body>", "<html><head><title>x</title>", "<head><title>x", "<title>On <p> and</title>",
                  "<html><head><meta charset=utf-8><noscript><p>no</p></noscript><script>'<div>'</script><title>x<body>"):
        assert text(start + article % "") == want, start
    for tag in ("button", "select", "noscript", "svg", "object", "iframe", "template"):
        for inside in (f"<{tag} id=a>label", f"<{tag} id='a\"b>label", f"<div><{tag}>label</div>", f"<{tag}>label<{tag}>label</{tag}>",
                       f"<{tag}><div><p>no</div></{tag}>", f"<{tag}>a<b>b</b></{tag}>"):
            assert text(f"<html><head></head><body>{article % inside}</body></html>") == want, inside
        for name in (f"{tag}-icon", f"{tag}:x"):
            assert text(f"<body>{article.replace('<p>', f'<p><{name}></{name}>') % ''}</body>") == want, name
            assert text(f"<body>{article.replace('<p>', f'<p><{name}>') % ''}</body>") == want, name
    assert text(f"<body>{article.replace('<p>', '<p><svg/>') % ''}</body>") == want


# ---------------------------------------------------------------- repeated passages


def brute_repeats(rows):
    first = {}
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        data = (text or "").encode()
        for p in range(len(data) - 49):
            first.setdefault(data[p:p + 50], np.inf if d is None else d)
    out = []
    for d, text in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for p in range(len(data) - 49):
            if first[data[p:p + 50]] < (np.inf if d is None else d):
                gone[p:p + 50] = True
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        spans = sum(bool(gone[k]) and not (k and gone[k - 1]) for k in range(len(data)))
        out.append((d, len(data), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("size", [1 << 14, 8 << 20])
def test_repeats_match_brute_force(monkeypatch, spark, docs, size):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", size)
    monkeypatch.setattr(repeats, "RANGE_BYTES", size)
    draw = random.Random(8)
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    # Pieces of other texts, cut and joined anywhere.
    for k in range(60):
        parts = [draw.choice(rows)[1] or "" for _ in range(3)]
        rows.append((10_000 + k, "".join(p[(a := draw.randrange(len(p) + 1)):a + draw.choice((30, 49, 50, 51, 75, 120, 400))] for p in parts)))
    table = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in repeats.remove_repeats(table).drop("spans").collect()), key=str)
    assert got == brute_repeats(rows)


def test_repeats_in_odd_rows(odd, empty):
    rows = [(r["doc_id"], r["text"]) for r in odd.collect() if len(r["text"] or "") < 10_000]
    table = odd.where("coalesce(length(text), 0) < 10000")
    assert sorted((tuple(r) for r in repeats.remove_repeats(table).drop("spans").collect()), key=str) == brute_repeats(rows)
    assert repeats.remove_repeats(odd).count() == odd.count() and repeats.remove_repeats(empty).count() == 0


@pytest.mark.parametrize("hot", [1, 30, 100])
def test_repeats_around_common_lines(monkeypatch, spark, docs, hot):
    monkeypatch.setattr(repeats, "BLOCK_BYTES", 1 << 14)
    monkeypatch.setattr(repeats, "RANGE_BYTES", 1 << 14)
    monkeypatch.setattr(repeats, "HOT", hot)
    draw = random.Random(5)

    def other(n):
        return "".join(draw.choice("abcdef \n") for _ in range(n))

    line = "This line of the licence stands in each text, whatever is around it."
    texts = [other(150) + line + other(150) for _ in range(60)] + [line, line + "x" * 40, line + "x" * 40 + "y"]
    rows = [*enumerate(texts), (None, texts[3]), (5, texts[7]), *[(100 + d, t) for d, t in texts_of(docs).items()]]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in repeats.remove_repeats(table).drop("spans").collect()), key=str) == brute_repeats(rows)


def test_no_range_holds_all_suffixes_of_a_common_gram():
    import pyarrow as pa

    draw, line, limit = random.Random(6), b"This line of the licence stands in each text, whatever is around it.", 200
    tables = []
    for block in range(3):
        texts = [("".join(draw.choice("abcdef ") for _ in range(200)).encode() + line + str(draw.random()).encode()).decode() for _ in range(100)]
        keys = [100 * block + k for k in range(100)]
        tables.append(pa.table({"doc_id": keys, "text": texts, "key": keys, "block": [block] * 100}))
    asked = pa.concat_tables([repeats._ask(1)(t) for t in tables])
    told = repeats._tell(limit)(asked)
    back = [told.filter(pa.compute.equal(told.column("block"), k)) for k in range(3)]
    sent = pa.concat_tables([repeats._send(1)(t, b) for t, b in zip(tables, back, strict=True)])
    runs = [r for r in sent.to_pylist() if r["range"] == 0]
    size: dict = {}
    for made in runs:
        run = repeats.Run(made["common"], made["rests"])
        while run.step() >= 0:
            gram = run.key[:repeats._SAME_GRAM]
            size[gram] = size.get(gram, 0) + 1
    assert max(size.values(), default=0) <= limit and any(r["range"] == 1 for r in sent.to_pylist())


def made_runs(draw, blocks, n, grams):
    """Runs of a range as blocks send them: sorted distinct suffixes of few grams, each with doc_ids of its block."""
    runs = []
    for block in range(blocks):
        made = set()
        for _ in range(n):
            gram = draw.randrange(grams)
            right, left = draw.choice((repeats.LENGTH, repeats.LENGTH, draw.randint(repeats.GRAM, repeats.LENGTH))), draw.choice((repeats.REACH, draw.randint(0, repeats.REACH)))
            after, before = ("".join(draw.choice("aaaaab\0") for _ in range(k)).encode() for k in (right - repeats.GRAM, left))
            made.add(b"%04d" % gram + (b"g%023d" % gram + after).ljust(repeats.LENGTH, b"\0") + before.ljust(repeats.REACH, b"\0") + bytes([right, left + 1]))
        keys = sorted(made)
        common = [0] + [next((k for k, (x, y) in enumerate(zip(a, b, strict=True)) if x != y)) for a, b in zip(keys, keys[1:], strict=False)]
        low = np.array([draw.randrange(30) for _ in keys], np.int64)
        high = low + np.array([draw.choice((0, 0, 7)) for _ in keys])
        runs.append((keys, low, high, (bytes(common), b"".join(k[c:] for k, c in zip(keys, common, strict=True)), low.tobytes(), high.tobytes())))
    return runs


@pytest.mark.parametrize("blocks,n,grams,piece", [(1, 1, 1, 8), (3, 5, 2, 8), (7, 40, 6, 64), (20, 60, 90, 1 << 17)])
def test_replies_to_runs_are_those_of_pairs_of_suffixes(monkeypatch, blocks, n, grams, piece):
    monkeypatch.setattr(repeats, "_PIECE", piece)
    draw = random.Random(blocks)
    for _ in range(5):
        runs = made_runs(draw, blocks, n, grams)
        lows: dict = {}
        for keys, low, _, _ in runs:
            for key, value in zip(keys, low.tolist(), strict=True):
                lows[key] = min(value, lows.get(key, value))
        told = {}
        for gram in {k[:repeats._SAME_GRAM] for k in lows}:
            own = sorted(k for k in lows if k[:repeats._SAME_GRAM] == gram)
            told |= dict(zip(own, repeats._segments(own, [lows[k] for k in own]), strict=True))
        for (keys, _, high, (common, rests, _, _)), reply in zip(runs, repeats._answers([r[3] for r in runs]), strict=True):
            run = repeats.Run(common, rests)
            assert [run.key for _ in keys if run.step() >= 0] == keys
            want = {(k, at, low) for k, key in enumerate(keys) for start, stop, low in told[key] for at in range(start, stop + 1) if low < high[k]}
            # A suffix alone is answered for all offsets; the block knows which of them it has.
            inside = [range(repeats.LENGTH - key[-2], key[-1]) for key in keys]
            lines = np.frombuffer(reply, repeats._REPLY).tolist()
            assert {(k, at, low) for k, start, stop, low in lines for at in range(start, stop + 1) if at in inside[k]} == want


def test_work_on_a_range_grows_with_its_bytes_and_not_with_blocks_or_calls():
    import sys
    import time

    import pyarrow as pa

    def calls(n):
        runs = made_runs(random.Random(n), 4, n, 3 * n)
        table = pa.table([pa.array([0] * 4), pa.array(range(4)), *[pa.array([r[3][k] for r in runs], pa.binary()) for k in range(4)]], schema=repeats._PAIR_SCHEMA)
        seen = [0]
        sys.setprofile(lambda *_: seen.__setitem__(0, seen[0] + 1))
        try:
            repeats._merge(1)(table)
        finally:
            sys.setprofile(None)
        return seen[0]

    assert calls(2000) < 2 * calls(200)

    def seconds(blocks, grams=200_000):
        rng, rows = np.random.default_rng(1), []
        for block in range(blocks):
            body = np.unique(rng.integers(0, grams // 2, grams // blocks).astype("<u4"))
            rows.append((0, block, body.tobytes(), np.packbits(np.zeros(len(body), bool)).tobytes(), b"", b""))
        table, took = repeats._table(rows, repeats._PAIR_SCHEMA), []
        for _ in range(3):
            began = time.process_time()
            repeats._tell(1 << 15)(table)
            took.append(time.process_time() - began)
        return min(took)

    assert seconds(800) < 4 * seconds(8)


# ---------------------------------------------------------------- fingerprints


def test_edited_texts_match_brute_force(docs):
    for table in (docs, docs.where("doc_id = 7")):
        texts = texts_of(table)
        order = sorted(texts, reverse=True)
        got = {r["doc_id"]: r for r in fingerprints.compare(table).collect()}
        for k, d in enumerate(order):
            text, after = texts[d] or "", texts[order[(k + 1) % len(order)]] or ""
            third = len(text) // 3
            want = text[:len(text) - third] + after[:third]
            row = got[d]
            assert row["n_chars"] == len(text) and row["edited_sha256"] == hashlib.sha256(want.encode()).hexdigest()
            assert row["fingerprint"] == fingerprints.written(fingerprints.sketch(text))
            assert row["edited_fingerprint"] == fingerprints.written(fingerprints.sketch(want))
            assert row["near_next"] == fingerprints.likeness(fingerprints.sketch(text), fingerprints.sketch(after))


def test_blocks_of_documents_agree(monkeypatch, docs):
    whole = sorted(tuple(r) for r in fingerprints.compare(docs).collect())
    monkeypatch.setattr(fingerprints, "BLOCK_BYTES", 1 << 15)
    assert sorted(tuple(r) for r in fingerprints.compare(docs).collect()) == whole


def test_syncmers_need_no_context():
    draw = random.Random(9)
    middle = "".join(draw.choice("abcdef ") for _ in range(400))
    alone = {h for h in fingerprints.syncmers(middle)[0].tolist()}
    for side in ("xyz" * 40, ""):
        assert alone <= set(fingerprints.syncmers(side + middle + side[::-1])[0].tolist())
    same = fingerprints.sketch(middle)
    assert fingerprints.likeness(same, same) == 1.0 and fingerprints.likeness(same, fingerprints.sketch("")) == 0.0


def test_fingerprints_of_odd_rows(odd, empty):
    got = fingerprints.compare(odd).collect()
    assert len(got) == odd.count() and fingerprints.compare(empty).count() == 0
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert len({r["fingerprint"] for r in got if r["doc_id"] in (4, 5)}) == 1


def test_a_passage_shared_by_long_texts(spark):
    draw = random.Random(21)
    passage, *long = ("".join(draw.choice("abcdefgh ") for _ in range(n)) for n in (400, 60_000, 90_000, 40_000))
    texts = [long[0] + passage, passage + long[1], long[2], passage]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in fingerprints.compare(table).collect()}
    for d, text in enumerate(texts):
        hashes, _ = fingerprints.syncmers(text)
        assert got[d]["anchors"] == len(hashes) and len(got[d]["fingerprint"].split()) == len(set(hashes.tolist()))
    shared = set(fingerprints.syncmers(passage)[0].tolist())
    for a, b in ((0, 1), (0, 3), (3, 1)):
        sets = [set(fingerprints.syncmers(texts[k])[0].tolist()) for k in (a, b)]
        like = fingerprints.likeness(fingerprints.sketch(texts[a]), fingerprints.sketch(texts[b]))
        assert like == pytest.approx(len(shared) / len(sets[0] | sets[1]), rel=0.05)
    assert got[1]["near_next"] > 0 and got[0]["near_next"] > 0


# ---------------------------------------------------------------- pipeline


def test_stages_on_the_smallest_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, FOLDER).cache()
        assert after.columns == docs.columns and after.count() > 0.5 * before.count(), name
        before = after
    assert corpus_pipeline.run(spark, FOLDER).count() == before.count()


def test_stages_on_odd_rows(spark, odd, empty):
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, odd, FOLDER).collect()
        assert stage(spark, empty, FOLDER).count() == 0


def test_near_duplicate_stage_keeps_one_of_each(spark, docs):
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, FOLDER).collect()}
    groups = near_duplicates.link(docs, width=5).collect()
    assert kept == {r["component_id"] for r in groups}


def test_ids_that_do_not_name_a_row(spark):
    copy, alone = "one two three four five six seven eight " * 5, "a text that stands nowhere else in this table at all"
    rows = [(1, copy), (2, copy), (2, alone), (3, alone + " but here"), (3, alone + " but here"), (None, copy), (None, "the text without an id is here"),
            (None, "the text without an id is here"), (None, None), (4, None), (4, "")]
    df = spark.createDataFrame([(k, t, "en", "s", i, "x", i, "y") for i, (k, t) in enumerate(rows)], SCHEMA)
    got = near_duplicates.one_of_each(df)
    assert got.columns == df.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=str)
    assert kept == sorted([(1, copy), (2, alone), (3, alone + " but here"), (None, "the text without an id is here"),
                           (None, None), (4, None), (4, "")], key=str)


def test_without_labels_the_language_stage_keeps_every_document(spark, docs):
    bare = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.identify_language(spark, bare, FOLDER).count() == docs.count()


def test_every_query_is_registered():
    import __spark_entry__ as entry

    assert {f"op{n}" for n in range(1, 11)} | {"pipeline"} <= {q.split("_")[0] for q in entry.queries()}


def test_suffixes_of_a_gram_in_pairs_or_by_windows_share_the_same_offsets():
    rng = np.random.default_rng(5)
    for size in (1, 2, 3, 9, 30):
        made = set()
        while len(made) < size:
            right, left = int(rng.integers(repeats.GRAM, repeats.LENGTH + 1)), int(rng.integers(0, repeats.REACH + 1))
            after = bytes(rng.choice([97, 97, 97, 97, 98], right - repeats.GRAM).astype(np.uint8).tolist())
            before = bytes(rng.choice([97, 97, 97, 97, 98], left).astype(np.uint8).tolist())
            made.add(b"hash" + (b"g" * repeats.GRAM + after).ljust(repeats.LENGTH, b"\0") + before.ljust(repeats.REACH, b"\0")
                     + bytes([right, left + 1]))
        contexts, lows = sorted(made), rng.integers(0, 6, size).tolist()
        assert repeats._segments(contexts, lows) == repeats._segments_of_many(contexts, lows)


def test_detections_inside_stronger_ones_go_as_in_all_pairs(monkeypatch):
    rng = random.Random(3)
    for _ in range(200):
        spans = [(s, s + rng.randint(1, 12)) for s in (rng.randint(0, 20) for _ in range(rng.randint(0, 25)))]
        found = [(s, e, rng.choice("abc"), rng.choice((40, 55, 60, 80, 100))) for s, e in spans]

        class Told:
            def __init__(self, one):
                self.label, self.priority, self.pattern, self.one = one[2], one[3], self, one

            def finditer(self, text):
                return [self]

            def start(self):
                return self.one[0]

            def end(self):
                return self.one[1]

        monkeypatch.setattr(licenses, "rules", lambda made=tuple(map(Told, found)): (((), made),))
        kept = []
        for one in sorted(set(found), key=lambda d: (-(d[1] - d[0]), -d[3], d[0], d[2])):
            if not any(k[0] <= one[0] and one[1] <= k[1] and k[3] >= one[3] for k in kept):
                kept.append(one)
        assert licenses.detections(b"") == sorted(kept)


def test_many_detections_in_one_text_take_linear_work():
    import time

    start = time.process_time()
    assert len(licenses.detections(b"gnu gpl and the x " * 120_000)) >= 120_000
    assert time.process_time() - start < 60
