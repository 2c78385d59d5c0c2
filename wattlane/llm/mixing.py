"""Mixing sources to target weights by pivotal dependent rounding; DataFrame operations only.

Every source has a target size.  Its documents are taken ``target / size`` times on average: the whole part of
that ratio for each document, and its fraction by dependent rounding.  A *pivot* pairs two documents whose
shares are fractions and moves mass from one to the other, so that the taken size stays as it is, until one
share is 0 or 1; a fair draw picks the direction, so that each share keeps its mean.  Documents are dealt into
small blocks by their hash, a block is folded with a higher-order function and leaves one fraction at most;
these residuals are dealt into blocks again, level by level, until a source has one left, which is rounded.
Shuffles carry a few numbers per document; the hot source is spread over its blocks like any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from wattlane.operators.ordering import with_positions
from wattlane.panel import Panel
from wattlane.session import materialize

#: Documents of a block on average.
BLOCK = 48
#: Times that a document is taken at most, which also bounds a source's target.
MOST = 3
#: Words are runs of other bytes than white space.
WORD = r"[^\x20\x09-\x0D]+"
#: Shares closer to 0 or 1 than this count as whole.
_NEAR = 1e-9


def words(text: Column) -> Column:
    """Number of words; 0 for NULL."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def targets(sizes: DataFrame, most: int = MOST) -> DataFrame:
    """``sizes`` (source, source_size; a row per source) with ``weight`` and ``target``.

    Sources in code-point order, NULL last, weigh 1, 2, 3, 1, ...; they share the whole size by weight, and a
    source that would exceed ``most`` times its size stops there while the others share the excess.  That is a
    level ``x`` with target ``min(most * size, x * weight)``: sources stop in the order of size over weight.
    """
    ranked = sizes.withColumn(
        "weight", ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % 3 + 1).cast("double"))
    cap = F.col("source_size") * F.lit(float(most))
    stop = ranked.withColumn("cap", cap).withColumn("ratio", F.col("cap") / F.col("weight"))
    order = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, every = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    level = (F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / (
        F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
    # The level as each source sees it that is the first not to stop; the first such source fixes it.
    seen = stop.withColumn("level", level).withColumn("open", F.col("level") <= F.col("ratio"))
    fixed = seen.withColumn("x", F.min(F.when(F.col("open"), F.struct("ratio", "level"))).over(every))
    target = F.when(F.col("x").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("x.level") * F.col("weight")))
    return fixed.select("source", "source_size", "weight", target.alias("target"))


#: A unit on its way through the levels, and one whose share has become whole.
_ITEM = ("struct<heavy:double,order:bigint,source:string,doc_id:bigint,size:bigint,key:bigint,n:bigint,"
         "mass:double,share:double,draw:double>")
_DONE = "struct<source:string,doc_id:bigint,size:bigint,key:bigint,n:bigint,extra:bigint>"


def _number(*parts: Column | str) -> Column:
    """A repeatable draw in [0, 1)."""
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 52)) / F.lit(float(1 << 52))


def _done(item: Column, share: Column) -> Column:
    return F.struct(
        *[item[c].alias(c) for c in ("source", "doc_id", "size", "key", "n")], F.round(share).cast("long").alias("extra")
    ).cast(_DONE)


def _pivot(state: Column, item: Column) -> Column:
    """One step of the fold: ``open`` is the unit whose share is a fraction yet, ``done`` the units decided.

    With masses s, t and shares p, q, mass m moves up on the first while p + m / s <= 1 and q - m / t >= 0, or down
    while p - m / s >= 0 and q + m / t <= 1; going up with probability down / (up + down) keeps both means.
    """
    held = state["open"]
    s, t, p, q = held["mass"], item["mass"], held["share"], item["share"]
    up, down = F.least((1 - p) * s, q * t), F.least(p * s, (1 - q) * t)
    moved = F.when(item["draw"] * (up + down) < down, up).otherwise(-down)
    first, second = p + moved / s, q - moved / t

    def whole(share: Column) -> Column:
        return (share < _NEAR) | (share > 1 - _NEAR)

    decided = (
        F.when(~whole(first), F.array(_done(item, second)))
        .when(~whole(second), F.array(_done(held, first)))
        .otherwise(F.array(_done(held, first), _done(item, second)))
    )
    still = (
        F.when(~whole(first), held.withField("share", first))
        .when(~whole(second), item.withField("share", second))
    )
    return F.struct(
        F.when(held.isNull(), item).otherwise(still).cast(_ITEM).alias("open"),
        F.when(held.isNull(), state["done"]).otherwise(F.concat(state["done"], decided)).alias("done"))


def round_shares(units: DataFrame, seed: int = 0, block: int = BLOCK) -> DataFrame:
    """Pivotal rounding of ``units`` (source, doc_id, size, key, n, mass, share; shares strictly between 0 and 1,
    masses above 0): the same units with ``extra`` (0 or 1) in place of mass and share.

    The taken mass of a source differs from its mean by half a unit at most.  Each level is written once and has
    about ``block`` times fewer rows than the one before.
    """
    left, level, decided = units, 0, []
    while True:
        count = materialize(left.groupBy("source").agg(F.count("*").alias("in_source")), "counts")
        most = count.agg(F.max("in_source")).first()[0] or 0
        if most <= 1:
            nearer = F.round("share").cast("long")
            decided.append(left.select("source", "doc_id", "size", "key", "n", nearer.alias("extra")))
            break
        salt = ("key", "doc_id", F.lit(seed), F.lit(level))
        blocks = F.ceil(F.col("in_source") / block)
        dealt = left.join(count.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).select(
            F.col("source").alias("of"), F.pmod(F.xxhash64(*salt), blocks).alias("block"),
            # Heavy ones first: what is left open at the end is rather a light one.
            F.struct(
                (-F.col("mass")).alias("heavy"), F.xxhash64(*salt, F.lit("order")).alias("order"), "source", "doc_id", "size", "key", "n", "mass", "share",
                _number(*salt, F.lit("draw")).alias("draw")).cast(_ITEM).alias("item"))
        start = F.struct(F.lit(None).cast(_ITEM).alias("open"), F.array().cast(f"array<{_DONE}>").alias("done"))
        folded = materialize(
            dealt.groupBy("of", "block").agg(F.sort_array(F.collect_list("item")).alias("items"))
            .select(F.aggregate("items", start, _pivot).alias("state")), "pivots")
        decided.append(folded.select(F.explode("state.done").alias("d")).select("d.*"))
        left = folded.where("state.open IS NOT NULL").select(
            *[f"state.open.{c}" for c in ("source", "doc_id", "size", "key", "n", "mass", "share")])
        level += 1
    out = decided[0]
    for part in decided[1:]:
        out = out.unionByName(part)
    return out


def row_key(text: str = "text") -> Column:
    """A number that tells rows with equal ``doc_id`` and ``source`` apart by their text."""
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")), F.col(text).isNull(), F.col("doc_id").isNull(), F.col("source").isNull())


def plan(docs: DataFrame, seed: int = 0) -> DataFrame:
    """How often each distinct row (doc_id, source, text) is taken.

    ``source``, ``doc_id``, ``size`` (words), ``key``, ``n`` (equal rows), ``base`` (times that each of them is taken),
    ``once_more`` (how many of them are taken once more), ``source_size`` and ``target`` (of the source).  Of n equal
    rows with share f the whole part of n * f is taken once more for certain and one row carries the fraction.
    """
    rows = docs.select(F.col("source").cast("string").alias("source"), F.col("doc_id").cast("long").alias("doc_id"),
                       words(F.col("text")).alias("size"), row_key().alias("key"))
    units = materialize(rows.groupBy("source", "doc_id", "size", "key").agg(F.count("*").alias("n")), "units")
    sizes = units.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goals = materialize(targets(sizes), "targets").select(F.col("source").alias("of"), "source_size", "target")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    near = F.abs(ratio - F.round(ratio)) < _NEAR
    by_source = F.col("source").eqNullSafe(F.col("of"))
    each = F.when(near, F.lit(0.0)).otherwise(ratio - F.floor(ratio))
    together = F.col("n") * F.col("each")
    sure = F.when(F.col("size") > 0, F.floor(together + _NEAR)).otherwise(F.lit(0)).cast("long")
    shared = (
        units.join(goals.select("of", each.alias("each")), by_source)
        .withColumn("sure", sure).withColumn("share", F.greatest(together - F.col("sure"), F.lit(0.0)))
        .select("source", "doc_id", "size", "key", "n", "sure", "share"))
    open_ = (F.col("share") > _NEAR) & (F.col("size") > 0)
    rounded = round_shares(shared.where(open_).drop("sure").withColumn("mass", F.col("size").cast("double")), seed)
    fixed = shared.where(~open_).select("source", "doc_id", "size", "key", "n", F.lit(0).cast("long").alias("extra"))
    base = F.when(near, F.round(ratio)).otherwise(F.floor(ratio)).cast("long")
    # What is certain follows from the source's ratio again, so it need not pass the levels.
    certain = F.when(F.col("size") > 0, F.floor(F.col("n") * each + _NEAR)).otherwise(F.lit(0)).cast("long")
    return rounded.unionByName(fixed).join(goals, by_source).select(
        "source", "doc_id", "size", "key", "n", base.alias("base"), (certain + F.col("extra")).alias("once_more"),
        "source_size", "target")


#: Equal rows that one step of numbering lists at once.
_LISTED = 1 << 16


def mix(docs: DataFrame, seed: int = 0) -> DataFrame:
    """One row per document: ``doc_id``, ``size`` (words), ``source_size``, ``target`` (of its source), ``copies``
    and ``taken`` (words taken, repeats counted).

    NULL, empty and blank texts have size 0; they are taken as often as the whole part of the ratio says.  A source
    without words has target 0.  A NULL source is a source, the last one.  Rows equal in doc_id, source and text
    share what they are taken evenly: their copies differ by one at most.  The same rows give the same result in
    any order.  An empty table gives an empty result.
    """
    planned = plan(docs, seed)
    lists = F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("n") - 1) / _LISTED)))
    first = F.col("_list") * _LISTED
    each = F.explode(F.sequence(first + 1, F.least(F.col("n"), first + _LISTED)))
    copies = F.col("base") + F.when(F.col("_row") <= F.col("once_more"), 1).otherwise(0)
    return planned.select("*", lists.alias("_list")).select("*", each.alias("_row")).withColumn("copies", copies).select(
        "doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


#: Rows of one unit: equal in source, doc_id and text.
_UNIT = ("_source", "_doc_id", "_key")


def mixed(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: rows of ``docs`` (all columns), each as often as it is taken.

    Rows that repeat doc_id, source and text are numbered, so that as many of them come once more as ``mix`` says.
    """
    planned = materialize(plan(docs, seed).select(
        F.coalesce("source", F.lit("")).alias("_source"), F.coalesce("doc_id", F.lit(0)).alias("_doc_id"),
        F.col("key").alias("_key"), F.col("n").alias("_n"), F.col("base").alias("_base"), F.col("once_more").alias("_more")
    ).where("_base > 0 OR _more > 0"), "planned")
    # The key tells NULLs from the values that stand for them here.
    rows = docs.withColumns({
        "_source": F.coalesce(F.col("source").cast("string"), F.lit("")),
        "_doc_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)), "_key": row_key()})
    taken = rows.join(planned.where("_n = 1"), list(_UNIT)).withColumn("_copies", F.col("_base") + F.col("_more"))
    repeated = planned.where("_n > 1")
    if not repeated.isEmpty():
        again = rows.join(repeated, list(_UNIT)).withColumns(
            {"_like": F.xxhash64(*docs.columns), "_at": F.monotonically_increasing_id()})
        numbered = with_positions(again, Panel(keys=_UNIT, ts="_like", tie=("_at",), pos="_number"))
        copies = F.col("_base") + F.when(F.col("_number") < F.col("_more"), 1).otherwise(0)
        taken = taken.select(*docs.columns, "_copies").unionByName(
            numbered.withColumn("_copies", copies).select(*docs.columns, "_copies"))
    times = F.explode(F.array_repeat(F.lit(0), F.col("_copies").cast("int")))
    return taken.where("_copies > 0").withColumn("_copy", times).select(docs.columns)
