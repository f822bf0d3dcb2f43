"""Benchmark decontamination: windows as long as the items, SimHash, exact similarity.

A window of a document leaks an item if the Jaccard similarity of their word shingles,
weighted or plain, is at least :data:`SIMILARITY`.  Windows are cut as long as the item, at every place
where they can hold enough of the item's shingles.  Windows and items get SimHash
fingerprints; a multi-index over blocks of the fingerprints finds every pair within
:data:`RADIUS` bits; such pairs are verified exactly.

DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from goldweft.llm.common import stage, words

SHINGLE = 5
SIMILARITY = 0.8
#: Fingerprints of 64 bits in 8 blocks of 8.  Within 15 differing bits one block differs in
#: at most one bit, so indexing each block with all its one-bit neighbours misses nothing
#: within the radius.
BITS, BLOCK, RADIUS = 64, 8, 15
#: Independent fingerprints; a pair counts as near if any of them is within the radius.
PRINTS = 2
#: An index of item shingles of at most so many rows is sent to all executors.
SENT = 500_000


def _fold(text: Column) -> Column:
    upper = "".join(map(chr, range(65, 91)))
    return F.translate(text, upper, upper.lower())


def _shingles(hashed: Column) -> Column:
    """Hashes of the shingles of an array of word hashes, in order; repeats stay.  With fewer
    words than a shingle has, the whole sequence is the only one."""

    def of(h: Column) -> Column:
        last = F.size(h) - SHINGLE
        one = lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(SHINGLE)])
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), last), one)).when(
            F.size(h) > 0, F.array(F.xxhash64(h))
        )

    # A variable of a lambda is evaluated once, wherever the optimizer moves the expression.
    return F.coalesce(F.get(F.transform(F.array(hashed), of), 0), F.array().cast("array<bigint>"))


def _texts(table: DataFrame, key: str, text: str) -> DataFrame:
    """``id`` and the shingles of every row with a key."""
    hashed = F.transform(words(_fold(F.col(f"`{text}`"))), lambda w: F.xxhash64(w))
    return table.filter(F.col(f"`{key}`").isNotNull()).select(
        F.col(f"`{key}`").cast("long").alias("id"), _shingles(hashed).alias("shingles")
    )


def weighted_items(benchmark: DataFrame, key: str = "item_id", text: str = "text") -> DataFrame:
    """item, shingle, place, weight and size (shingles) of every item.

    A shingle weighs 1 / (items that hold it): what many items share, such as a set phrase,
    says less about any of them.  What no item holds weighs 1, so of items that repeat or
    share a preamble a near copy may be below the similarity by weight; those are judged by
    plain counts as well (see :func:`leaks`).
    """
    items = _texts(benchmark, key, text).dropDuplicates(["id", "shingles"])
    placed = items.select(
        F.col("id").alias("item"), F.size("shingles").alias("size"), F.posexplode("shingles").alias("place", "shingle")
    )
    spread = placed.groupBy("shingle").agg((1 / F.count_distinct("item")).alias("weight"))
    return placed.join(spread, "shingle").dropDuplicates(["item", "shingle"])


def _fingerprints(sets: DataFrame, by: list[str]) -> DataFrame:
    """``by``, print (number) and bits: the SimHash of each group's weighted shingles."""
    numbered = sets.select(*by, "shingle", "weight", F.explode(F.sequence(F.lit(0), F.lit(PRINTS - 1))).alias("print"))
    signed = numbered.select(*by, "print", "weight", F.xxhash64("shingle", "print").alias("h"))
    votes = signed.groupBy(*by, "print").agg(
        *[F.expr(f"sum(if(getbit(h, {i}) = 1, weight, -weight))").alias(f"s{i}") for i in range(BITS)]
    )
    ones = ", ".join(f"if(s{i} > 0, shiftleft(1L, {i}), 0L)" for i in range(BITS))
    bits = F.expr(f"aggregate(array({ones}), 0L, (x, y) -> x | y)")
    return stage(votes.select(*by, "print", bits.alias("bits")), "prints")


def _block(bits: Column, i: Column) -> Column:
    """Block number i of the bits."""
    return F.call_function("shiftrightunsigned", bits, i * BLOCK).bitwiseAND(F.lit((1 << BLOCK) - 1))


def near_prints(windows: DataFrame, items: DataFrame, on: list[str]) -> DataFrame:
    """All pairs of the two tables that agree in ``on`` and have some fingerprint within
    :data:`RADIUS` bits.  Both hold print and bits; the other columns come along."""
    blocks = BITS // BLOCK
    number = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    flips = F.array(F.lit(0), *[F.lit(1 << b) for b in range(BLOCK)])
    index = (
        items.withColumnRenamed("bits", "item_bits")
        .withColumn("block", number)
        .withColumn("flip", F.explode(flips))
        .withColumn("value", _block(F.col("item_bits"), F.col("block")).bitwiseXOR(F.col("flip").cast("long")))
        .drop("flip")
    )
    asked = windows.withColumn("block", number).withColumn("value", _block(F.col("bits"), F.col("block")))
    return asked.join(index, [*on, "print", "block", "value"]).filter(
        F.bit_count(F.col("bits").bitwiseXOR(F.col("item_bits"))) <= RADIUS
    )


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """``key``, ``item``, n_windows, start and similarity: one row for each document and item
    of which a window leaks, with the number of such windows and the first of the most
    similar ones (place of its first word, from 0).  The similarity is the weighted one where
    that reaches :data:`SIMILARITY`, else the plain one; windows of the former come first.

    A window has as many words as the item, or the whole text where that is shorter.  Words
    are cut at ASCII white space, A-Z as a-z.  An item of fewer words than a shingle is leaked
    by a text that holds these words and no others: within longer texts such short phrases
    say nothing.  Null texts are empty; rows without a key or item id take no part; rows
    that repeat a key are one document's.  Other columns are ignored.
    """
    items = stage(weighted_items(benchmark, item, item_text), "items")
    total = items.groupBy("item").agg(
        F.sum("weight").alias("item_weight"), F.max("size").alias("size"), F.count("*").alias("item_count")
    )
    wanted = items.select("shingle").distinct()
    if wanted.count() <= SENT:
        wanted = F.broadcast(wanted)
    # The outer form keeps the optimizer from testing the arrays beforehand, which would
    # make them twice.
    placed = _texts(docs, key, text).select(
        F.col("id").alias("doc"),
        F.size("shingles").alias("length"),
        F.posexplode_outer("shingles").alias("at", "shingle"),
    )
    # The places of a document that hold a shingle of some item; all others share nothing.
    seeds = stage(placed.join(wanted, "shingle", "left_semi"), "seeds")
    hits = seeds.join(items.drop("size"), "shingle")
    # A window reaches a similarity only if its document holds that share of the item.
    enough = (
        hits.select("doc", "item", "shingle", "weight")
        .distinct()
        .groupBy("doc", "item")
        .agg(F.sum("weight").alias("held"), F.count("*").alias("n_held"))
        .join(total, "item")
        .filter(
            (F.col("held") >= SIMILARITY * F.col("item_weight") - 1e-9)
            | (F.col("n_held") >= SIMILARITY * F.col("item_count") - 1e-9)
        )
        .select("doc", "item", "size", "item_weight", "item_count")
    )
    near = hits.select("doc", "item", "at", "length").join(enough, ["doc", "item"])
    first = F.greatest(F.lit(0), F.col("at") - F.col("size") + 1)
    last = F.least(F.col("at"), F.greatest(F.lit(0), F.col("length") - F.col("size")))
    starts = near.select(
        "doc", "item", "size", "item_weight", "item_count", F.explode(F.sequence(first, F.greatest(first, last))).alias("start")
    ).distinct()
    return _verified(docs, stage(starts, "starts"), items, key, text, item)


def _verified(docs: DataFrame, starts: DataFrame, items: DataFrame, key: str, text: str, item: str) -> DataFrame:
    windows = starts.select("doc", "start", "size").distinct()
    wanted = windows.groupBy("doc").agg(F.collect_list(F.struct("start", "size")).alias("windows"))
    # Windows see all their shingles, not only those of items.  Where one key stands on
    # several texts, each text has the window, as a version of its own.
    cut = (
        _texts(docs, key, text)
        .withColumnRenamed("id", "doc")
        .join(wanted, "doc")
        .select("doc", "shingles", F.explode("windows").alias("w"))
        .filter(F.col("w.start") <= F.greatest(F.lit(0), F.size("shingles") - F.col("w.size")))
        .select("doc", "w.*", F.array_distinct(F.slice("shingles", F.col("w.start") + 1, F.col("w.size"))).alias("own"))
    )
    cut = cut.withColumn("version", F.xxhash64("own"))
    window = ["doc", "start", "size", "version"]
    cut = stage(cut.dropDuplicates(window), "windows")
    weights = items.groupBy("shingle").agg(F.first("weight").alias("weight"))
    loose = cut.select(*window, F.explode("own").alias("shingle"))
    weighed = stage(
        loose.join(weights, "shingle", "left").withColumn("weight", F.coalesce("weight", F.lit(1.0))), "weighed"
    )
    # Where each of an item's shingles weighs 1, the plain similarity is never the greater
    # one.  The other items, and the windows cut for them, get prints of plain counts too.
    light = starts.filter(F.col("item_weight") < F.col("item_count") - 1e-9)
    plain_windows = light.select("doc", "start", "size").distinct()
    plain_items = light.select("item").distinct()
    counted = weighed.join(plain_windows, ["doc", "start", "size"], "left_semi").withColumn("weight", F.lit(1.0))
    counted_items = items.join(plain_items, "item", "left_semi").withColumn("weight", F.lit(1.0))
    # One aggregation for all four kinds of sets: with its sums for each bit it is by far the
    # largest plan here, and the driver holds it once.
    sets = [
        rows.select(
            F.lit(plain).alias("plain"),
            *[c for c in (*window, "item", "shingle", "weight") if c in rows.columns],
        )
        for plain, rows in ((False, weighed), (False, items), (True, counted), (True, counted_items))
    ]
    together = reduce(lambda x, y: x.unionByName(y, allowMissingColumns=True), sets)
    prints = _fingerprints(together, ["plain", *window, "item"])
    pairs = (
        near_prints(
            prints.filter("item IS NULL").drop("item"),
            prints.filter("item IS NOT NULL").drop("doc", "start", "version"),
            ["plain", "size"],
        )
        .select(*window, "item")
        .distinct()
        .join(starts, ["doc", "start", "size", "item"])
    )
    sums = weighed.groupBy(*window).agg(
        F.sum("weight").alias("own_weight"), F.count("*").alias("own_count")
    )
    both = (
        weighed.join(pairs, window)
        .join(items.select("item", "shingle"), ["item", "shingle"])
        .groupBy(*window, "item", "item_weight", "item_count")
        .agg(F.sum("weight").alias("both"), F.count("*").alias("both_count"))
        .join(sums, window)
    )
    of = lambda b, x, y: F.round(F.col(b) / (F.col(x) + F.col(y) - F.col(b)), 9)
    scored = (
        both.withColumn("weighted", of("both", "own_weight", "item_weight"))
        .withColumn("by_weight", F.col("weighted") >= SIMILARITY)
        .withColumn(
            "similarity",
            F.when(F.col("by_weight"), F.col("weighted")).otherwise(of("both_count", "own_count", "item_count")),
        )
        .filter(F.col("similarity") >= SIMILARITY)
    )
    order = F.struct(F.col("by_weight"), F.col("similarity"), -F.col("start"))
    return (
        scored.groupBy(F.col("doc").alias(key), F.col("item").alias(item))
        .agg(
            F.count("*").alias("n_windows"),
            F.max_by("start", order).alias("start"),
            F.max_by("similarity", order).alias("similarity"),
        )
        .select(key, item, "n_windows", "start", "similarity")
    )


def remove_leaks(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without those of documents that leak an item."""
    found = leaks(docs, benchmark, key, text).select(F.col(key).alias("__leak")).distinct()
    return docs.join(found, F.col(f"`{key}`").cast("long") == F.col("__leak"), "left_anti")
