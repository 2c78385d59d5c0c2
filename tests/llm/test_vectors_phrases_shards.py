"""Whitening, collocations and sharding against brute force and SQL, odd rows included."""

import math
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from oracle_compare import compare, connect
from wattlane.llm import collocations, queries, sharding, whitening

SMALL = "/root/testdata/sf0.001"


# Whitening


def exact_moments(rows):
    n, size = len(rows), len(rows[0])
    sums = [sum(r[i] for r in rows) for i in range(size)]
    cross = [[sum(r[i] * r[j] for r in rows) for j in range(size)] for i in range(size)]
    return n, sums, cross


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 130), st.integers(1, 5), st.sampled_from([1, 40, 10**6, 1 << 40, 1 << 62]), st.integers(0, 9999))
def test_bit_planes_give_exact_products(n, size, top, seed):
    rng = np.random.default_rng(seed)
    block = rng.integers(-top, top, (n, size), endpoint=True)
    sums, cross = whitening.scatter(block)
    _, want, products = exact_moments([[int(v) for v in r] for r in block])
    assert list(sums) == want and cross.tolist() == products


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, size string, n int")


def test_whitening_matches_brute_force_and_drops_what_is_not_a_vector(spark):
    rng = np.random.default_rng(5)
    good = rng.normal(0, [1, 2, 3, 4], (300, 4)).astype(np.float32)
    rows = [(k, [float(c) for c in v], "x", 1) for k, v in enumerate(good)]
    rows += [rows[0], (None, [float(c) for c in good[1]], None, None)]
    bad = [(900, None, "x", 1), (901, [1.0, None, 2.0, 3.0], "x", 1), (902, [math.nan] * 4, "x", 1),
           (903, [math.inf, 0.0, 0.0, 0.0], "x", 1), (904, [], "x", 1), (905, [1.0, 2.0], "x", 1)]
    out = whitening.whiten(spark, vectors(spark, rows + bad).repartition(5)).collect()
    ints = [[math.floor(64 * c) + 1_000_000 for c in r[1]] for r in rows]
    n, sums, cross = exact_moments(ints)
    assert len(out) == n * 4 and not {r["vec_id"] for r in out} & {900, 901, 902, 903, 904, 905}
    cov = np.array([[(n * cross[i][j] - sums[i] * sums[j]) / n**2 for j in range(4)] for i in range(4)])
    values = np.linalg.eigvalsh(cov)[::-1]
    by_key = {}
    for r in out:
        assert r["n"] == n and r["identity_error"] < 1e-9
        assert math.isclose(r["explained"], values[r["component"] - 1] / np.trace(cov), rel_tol=1e-9)
        by_key.setdefault(r["vec_id"], []).append(r)
    for k in (3, 77, 299):
        want = sum((n * x - s) ** 2 for x, s in zip(ints[k], sums))
        got = sorted(by_key[k], key=lambda r: r["component"])
        assert [r["deviation"] for r in got] == [want] * 4
        # Over all components the whitened vector keeps its Mahalanobis length, whatever the signs.
        centred = np.array([x - s / n for x, s in zip(ints[k], sums)])
        assert math.isclose(sum(r["whitened"] ** 2 for r in got), centred @ np.linalg.solve(cov, centred), rel_tol=1e-9)
    assert len(by_key[0]) == 8 and len(by_key[None]) == 4


def test_whitening_of_degenerate_tables(spark):
    assert whitening.whiten(spark, vectors(spark, [])).count() == 0
    assert whitening.whiten(spark, vectors(spark, [(1, None, "", 0), (2, [math.nan], "", 0)])).count() == 0
    one = whitening.whiten(spark, vectors(spark, [(1, [1.0, 2.0], "", 0)])).collect()
    assert [(r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in one] == [(0, None, 0.0, 0.0)] * 2
    # Two dimensions that are the same: one component has variance.
    flat = whitening.whiten(spark, vectors(spark, [(k, [float(k), float(k)], "", 0) for k in range(9)])).collect()
    assert {r["component"] for r in flat if r["whitened"] is None} == {2} and flat[0]["identity_error"] < 1e-9
    # Entries beyond a long, and squares beyond one.
    huge = whitening.whiten(spark, vectors(spark, [(1, [1e30, 0.0], "", 0), (2, [-1e30, 1.0], "", 0), (3, [0.0, 5.0], "", 0)]))
    assert {(r["vec_id"], r["deviation"]) for r in huge.collect()} == {(1, None), (2, None), (3, (3 * 320 - 384) ** 2)}


def test_whitening_query(spark):
    out = queries.op11_whitening(spark, SMALL).toPandas()
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").toPandas()
    ints = np.floor(64 * np.stack(rows["embedding"]).astype(float)).astype(int) + 1_000_000
    n, sums = len(ints), ints.sum(axis=0)
    wide = out.pivot(index="vec_id", columns="component", values="whitened").loc[rows["vec_id"]].to_numpy()
    assert wide.shape == (n, 32) and np.abs(np.cov(wide.T, bias=True) - np.eye(32)).max() < 1e-9
    values, basis = np.linalg.eigh(np.cov(ints.T, bias=True))
    want = (ints - sums / n) @ basis[:, ::-1][:, :32] / np.sqrt(values[::-1][:32])
    assert np.abs(np.abs(wide) - np.abs(want)).max() < 1e-6
    deviation = out.groupby("vec_id")["deviation"].first().loc[rows["vec_id"]].to_numpy()
    assert (deviation == ((n * ints - sums) ** 2).sum(axis=1)).all()


# Collocations


@settings(max_examples=60, deadline=None)
@given(st.integers(2, 5), st.sampled_from([1, 3, 17, 25, 31, 33]), st.integers(0, 999), st.integers(0, 4))
def test_filters_give_back_what_they_took(m, bits, seed, spread):
    rng = np.random.default_rng(seed)
    grams = rng.integers(0, 1 << min(bits, 40), (200, m))
    limbs, entry, counts = collocations.distinct(grams, m, bits)
    widths = collocations.limb_widths(m * bits)
    back = collocations.unpack(collocations.permute(limbs, widths, back=True), m, bits)
    assert (back[entry] == grams).all() and counts.sum() == 200
    spread = min(spread, widths[0])
    counts = counts * rng.choice([1, 1, 127, 129, 130, 16_000, 1 << 45], len(counts))
    shards = (limbs[0] >> np.uint64(widths[0] - spread)).astype(int) if spread else np.zeros(len(counts), int)
    for shard in np.unique(shards):
        mine = shards == shard
        data = collocations.to_filter([x[mine] for x in limbs], counts[mine], widths, spread)
        again, sizes = collocations.from_filter(data, int(mine.sum()), int(shard), widths, spread)
        assert all((a == b[mine]).all() for a, b in zip(again, limbs)) and (sizes == counts[mine]).all()


def brute_phrases(rows, least, top):
    """Counts of all n-grams by plain dictionaries, then scores, containment and order as stated."""
    low = {**{c: c + 32 for c in range(65, 91)}}
    grams, totals, out = {}, Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        pieces = [[]]
        for c in (text or "").translate(low) + ".":
            if c in ".,;:!?\n\x0b\x0c\r":
                pieces.append([])
            else:
                pieces[-1].append(c)
        for piece in pieces:
            words = [w for w in "".join(piece).replace("\t", " ").split(" ") if w]
            totals[lang] += len(words)
            for m in range(1, 6):
                for i in range(len(words) - m + 1):
                    grams.setdefault(lang, Counter())[tuple(words[i:i + m])] += 1
    for lang, counts in grams.items():
        cands = {g: f for g, f in counts.items() if len(g) > 1 and f >= least}
        held = []
        for g, a in cands.items():
            cuts = [(1000 * a * totals[lang] // (counts[g[:k]] * counts[g[k:]]), k) for k in range(1, len(g))]
            score, k = min(cuts)
            if any(f >= a and len(o) > len(g) and any(o[i:i + len(g)] == g for i in range(len(o)))
                   for o, f in cands.items()):
                continue
            held.append((-score, -a, " ".join(g).encode(), counts[g[:k]], counts[g[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(held)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def test_phrases_match_brute_force(spark):
    rng = np.random.default_rng(2)
    words = ["the", "The", "of", "é", "x\x01", "x", "a-b", "naïve", "日本", "of it", "w\x1f"]
    rows = []
    for k in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", "?", "\r\n"])
                       for _ in range(rng.integers(0, 60)))
        rows.append((k, text, [None, "en", "", "und"][k % 4]))
    rows += [(None, None, "en"), (1, "", "en"), (2, " \t ", None), (3, "...", "xx"), (4, "once only", "yy")]
    rows += [(5, "one long line of words again", "en")] * 9 + [(6, "z " * 4000, "zz")]
    docs = spark.createDataFrame([(i, t, v, 1, "q") for i, t, v in rows], "doc_id long, text string, lang string, n int, ids string")
    got = sorted(tuple(r) for r in collocations.mine(docs.repartition(4), least=5, top=25).collect())
    want = brute_phrases([(t, v) for _, t, v in rows], 5, 25)
    assert got == want and len({r[0] for r in want}) == 4


def test_phrases_in_many_blocks_and_shards(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"w{v}" for v in rng.zipf(1.5, 200) if v < 50), "en") for k in range(60)]
    monkeypatch.setattr(collocations, "SHARD_BYTES", 2000)
    monkeypatch.setattr(collocations, "BLOCK_BYTES", 3000)
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(6)
    got = sorted(tuple(r) for r in collocations.mine(docs, least=3, top=10_000).collect())
    assert got == brute_phrases([(t, v) for _, t, v in rows], 3, 10_000)


def test_no_phrases(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert collocations.mine(docs).count() == 0
    docs = spark.createDataFrame([(1, "a b c", "en"), (2, None, None)], "doc_id long, text string, lang string")
    assert collocations.mine(docs).count() == 0


def test_collocation_query(spark):
    con = connect(SMALL)
    assert compare(spark, con, SMALL, queries.op12_collocations, collocations.SQL) is None


# Sharding


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 2**40), st.integers(1, 40))
def test_permutation_can_be_undone(total, seed, shards):
    order = sharding.Shuffle(total, seed)
    numbers = np.arange(total)
    places = order.place(numbers)
    assert sorted(places.tolist()) == numbers.tolist() and (order.origin(places) == numbers).all()
    shard, slot = order.shard_and_slot(numbers, shards)
    assert (order.row_at(shard, slot, shards) == numbers).all()
    counts = np.bincount(shard, minlength=shards)
    assert counts.max() - counts.min() <= 1
    for s in range(min(shards, total)):
        assert sorted(slot[shard == s].tolist()) == list(range(counts[s]))


def odd_documents(spark):
    rows = [(k, f"text {k} é", "s") for k in range(60)] + [(7, "text 7 é", "t")] * 40 + [(8, "other", "s")]
    rows += [(None, None, None)] * 5 + [(None, "", "s"), (61, None, "s"), (62, "", "s"), (63, "long " * 50_000, "s")]
    return rows, spark.createDataFrame([(a, b, c, 1) for a, b, c in rows], "doc_id long, text string, shard string, size int")


def test_plan_matches_brute_force_on_odd_rows(spark):
    rows, docs = odd_documents(spark)
    got = sorted(map(str, (tuple(r)[:7] for r in sharding.plan(spark, docs.repartition(7)).collect())))
    again = sorted(map(str, (tuple(r)[:7] for r in sharding.plan(spark, docs.repartition(3)).collect())))
    assert got == again
    order = sharding.Shuffle(len(rows))
    shard, slot = order.shard_and_slot(np.arange(len(rows)), 24)
    keyed = sorted(((i is not None, i or 0, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, _ in rows))
    want = [(k[1] if k[0] else None, k[2], k[3], "rows", int(shard[n]), int(slot[n]), None) for n, k in enumerate(keyed)]
    assert got == sorted(map(str, want))


def test_shards_of_an_empty_table(spark):
    assert sharding.plan(spark, spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_written_shards_hold_all_texts_in_slot_order(spark, tmp_path):
    rows, docs = odd_documents(spark)
    path = str(tmp_path / "shards")
    sharding.write(spark, docs, path, shards=5)
    back = spark.read.parquet(path)
    assert sorted(map(str, ((r["doc_id"], r["text"]) for r in back.collect()))) == sorted(map(str, ((i, t) for i, t, _ in rows)))
    for s in range(5):
        slots = [r["slot"] for r in back.where(back["shard"] == s).collect()]
        assert sorted(slots) == list(range(len(slots)))


@pytest.mark.parametrize("query", ["op13_sharding"])
def test_sharding_query(spark, query):
    out = queries.QUERIES[query](spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").toPandas()
    assert sorted(out["doc_id"]) == sorted(docs["doc_id"]) and set(out["law"]) == {"rows"}
    assert out["size"].sum() == sum(len(t.encode()) + 8 for t in docs["text"].fillna(""))
    counts = out.groupby("shard")["slot"].agg(["count", "min", "max"])
    assert len(counts) == 24 and counts["count"].max() - counts["count"].min() <= 1
    assert (counts["min"] == 0).all() and (counts["max"] == counts["count"] - 1).all()
    # The order is a shuffle: neighbours by doc_id are not neighbours in the shards.
    places = (out["slot"] * 24 + out["shard"])[out["doc_id"].argsort()].to_numpy()
    assert abs(np.corrcoef(np.arange(len(places)), places)[0, 1]) < 0.3
