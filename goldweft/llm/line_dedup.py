"""Removal of repeated and nearly repeated lines by a deletion-neighbourhood join.

The edit distance is counted in words: two lines are near if one word is put in, left out or
replaced.  Then the lines without that word (its deletion variants) are equal, so it is
enough to hash every variant and to join equal hashes; no two lines are compared otherwise.

A variant's hash is a sum over its words and their places, so all variants of a line come from
two running sums.  Variants are only made for lines that share half of their words, at the
same end, with another line: a near line always does, as one edit leaves one half whole.

DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from goldweft.llm.common import stage, words

#: From so many words on, lines are near within one edit: at least 0.8 of the words agree.
#: Shorter lines must be equal.  More edits are not allowed for in longer lines, as the
#: variants without two words grow with the square of the line.
NEAR_WORDS = 5
#: Bits of the filter that tells which documents have a line of interest: 16 MB, whatever
#: the input.  A fuller one lets more texts be shuffled; results stay the same.
FILTER_BITS = 27


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """row (all columns of ``docs``), doc, version (a hash of the text: rows that share a key
    may hold different texts) and text."""
    column = F.col(f"`{text}`")
    return docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(f"`{key}`").cast("long").alias("doc"),
        F.xxhash64(column).alias("version"),
        column.alias("text"),
    )


def _lines(texts: DataFrame) -> DataFrame:
    """doc, version, place (from 0), words and their number n of every line."""
    lines = texts.select(
        "doc",
        "version",
        # The outer form keeps the optimizer from splitting once more for a filter.
        F.posexplode_outer(F.split(F.coalesce("text", F.lit("")), "\n")).alias("place", "line"),
    ).filter("doc IS NOT NULL")
    return lines.select("doc", "version", "place", words("line").alias("words")).withColumn("n", F.size("words"))


def _bit(*columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(1 << FILTER_BITS))


def _filter_of(rows: DataFrame, *columns: str) -> DataFrame:
    """The distinct values of ``columns`` as a bitmap: 4,096 rows of 4 KB at most."""
    return (
        rows.select(_bit(*columns).alias("bit"))
        .groupBy(F.shiftright("bit", 15).alias("part"))
        .agg(F.bitmap_construct_agg(F.col("bit") % 32768).alias("bits"))
    )


def _marked(rows: DataFrame, bitmap: DataFrame, *columns: str) -> DataFrame:
    """``rows`` with ``maybe``: false only where the bitmap does not have the row's values."""
    bit = _bit(*columns)
    byte = F.substring("bits", ((bit % 32768) / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    # The bitmap's size is bounded, so it is sent to all tasks.
    return (
        rows.withColumn("part", F.shiftright(bit, 15))
        .join(F.broadcast(bitmap), "part", "left")
        .withColumn("maybe", F.coalesce(F.getbit(value, (bit % 8).cast("int")) == 1, F.lit(False)))
        .drop("part", "bits")
    )


def _halves() -> Column:
    """Hashes of the beginnings and ends of a line by which a near line can be found.

    A line of n words and one of n or n + 1 words, one edit apart, have in common the first
    or the last floor(n / 2) words.  The longer one does not know the other's length, so it
    offers the halves for n - 1 words too.
    """
    n = F.col("n")
    halves = []
    for m in ((n / 2).cast("int"), ((n - 1) / 2).cast("int")):
        halves.append(F.xxhash64(F.lit("begin"), m, F.slice("words", 1, m)))
        halves.append(F.xxhash64(F.lit("end"), m, F.slice("words", n - m + 1, m)))
    return F.array_distinct(F.array(*halves))


def _order() -> Column:
    """(document, place) as one number that sorts the same way."""
    return F.col("doc").cast("decimal(38,0)") * F.lit(1 << 32).cast("decimal(12,0)") + F.col("place")


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc, version (the hash of the text) and place of every line to remove.

    A line goes if an earlier one (smaller ``key``, then smaller place) is equal or, from
    :data:`NEAR_WORDS` words on, near; lines are judged on the input, so the earlier one may
    go as well.  Lines are cut at U+000A and compared as words between ASCII white space;
    lines without words stay.
    """
    texts = _texts(docs, key, text).drop("row")
    keys = stage(
        _lines(texts)
        .filter("n > 0")
        .select(
            "doc",
            "version",
            "place",
            F.xxhash64("words").alias("k0"),
            F.xxhash64(F.lit(1), "words").alias("k1"),
            F.when(F.col("n") >= NEAR_WORDS, _halves()).alias("halves"),
        ),
        "lines",
    )
    # Of equal lines the earliest stands for all.
    distinct = keys.groupBy("k0", "k1").agg(
        F.min(_order()).alias("first"), F.count("*").alias("copies")
    )
    near = _near(texts, keys, distinct)
    gone = distinct.join(near, ["k0", "k1"], "left").filter("copies > 1 OR near")
    return (
        keys.select("doc", "version", "place", "k0", "k1", _order().alias("at"))
        .join(gone.select("k0", "k1", "first", "near"), ["k0", "k1"])
        .filter("near OR at > first")
        .select("doc", "version", "place")
    )


def _near(texts: DataFrame, keys: DataFrame, distinct: DataFrame) -> DataFrame:
    """k0, k1 and near (true) of the distinct lines that have an earlier line within one edit."""
    halves = keys.filter("halves IS NOT NULL").select("k0", "k1", F.explode("halves").alias("half"))
    # A half that two different lines share.  min and max differ iff there are two.
    shared = (
        halves.groupBy("half")
        .agg(F.min("k0").alias("lo"), F.max("k0").alias("hi"))
        .filter("lo <> hi")
        .select("half")
    )
    candidates = halves.join(shared, "half").select("k0", "k1").distinct().join(distinct, ["k0", "k1"])
    # One line of each: the text is read again for the documents that hold one.
    chosen = candidates.select(
        "k0",
        "k1",
        "first",
        F.floor(F.col("first") / F.lit(1 << 32).cast("decimal(12,0)")).cast("long").alias("doc"),
        F.pmod(F.col("first"), F.lit(1 << 32).cast("decimal(12,0)")).cast("int").alias("place"),
    )
    chosen = stage(chosen, "chosen")
    wanted = chosen.groupBy("doc").agg(F.collect_list(F.struct("place", "first", "k0", "k1")).alias("wanted"))
    source = _marked(texts.select("doc", "text"), _filter_of(chosen, "doc"), "doc").filter("maybe")
    read = (
        source.join(wanted, "doc")
        .select("wanted", F.split("text", "\n").alias("lines"))
        .select("lines", F.explode("wanted").alias("w"))
        .select("w.*", F.get("lines", F.col("w.place")).alias("line"))
        .select("k0", "k1", "first", words("line").alias("words"))
        # Rows that share a key may have other words there.
        .filter((F.xxhash64("words") == F.col("k0")) & (F.xxhash64(F.lit(1), "words") == F.col("k1")))
        .dropDuplicates(["k0", "k1"])
    )
    read = stage(read, "near-lines")
    variants = stage(_variants(read), "variants")
    groups = (
        variants.groupBy("v0", "v1", "n", "cut")
        .agg(F.min("first").alias("least"), F.count("*").alias("members"))
        .filter("members > 1 OR cut = 0")
    )
    # Replaced words: variants cut at the same place.  Put in or left out: a variant equal
    # to a whole line (cut 0).
    same = variants.filter("cut > 0").join(groups.filter("cut > 0 AND members > 1"), ["v0", "v1", "n", "cut"])
    whole = variants.filter("cut = 0").select("v0", "v1", "n", "first")
    longer = (
        variants.filter("cut > 0")
        .withColumnRenamed("first", "own")
        .join(whole.withColumnRenamed("first", "least"), ["v0", "v1", "n"])
        .select("k0", "k1", F.col("own").alias("first"), "least")
    )
    shortest = (
        variants.filter("cut > 0")
        .groupBy("v0", "v1", "n")
        .agg(F.min("first").alias("least"))
    )
    shorter = variants.filter("cut = 0").join(shortest, ["v0", "v1", "n"]).select("k0", "k1", "first", "least")
    pairs = (
        same.select("k0", "k1", "first", "least")
        .unionByName(longer)
        .unionByName(shorter)
        .filter("least < first")
        .distinct()
    )
    return _verify(pairs, read)


def _variants(lines: DataFrame) -> DataFrame:
    """k0, k1, first, the two hash sums v0 and v1, n (words) and cut (the place left out from
    1 on, 0 for the whole line) of every line and its deletion variants."""
    word = F.col("word")
    # Lines are dealt out before they are cut into words, so the sums below need no shuffle.
    placed = lines.repartition("k0", "k1").select(
        "k0", "k1", "first", F.size("words").alias("size"), F.posexplode("words").alias("p", "word")
    )
    # 44 bits each: sums of many words stay far below 2^63.
    term = lambda seed, shift: F.shiftrightunsigned(F.xxhash64(F.lit(seed), word, F.col("p") - shift), 20)
    terms = placed.select(
        "k0", "k1", "first", "size", "p",
        term(1, 0).alias("a0"), term(2, 0).alias("a1"),  # the word at its place
        term(1, 1).alias("b0"), term(2, 1).alias("b1"),  # and one place further ahead
    )
    line = Window.partitionBy("k0", "k1")
    before = line.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    run = terms.select(
        "k0", "k1", "first", "size", "p",
        (total("a0", before) + total("b0", line) - total("b0", before) - F.col("b0")).alias("v0"),
        (total("a1", before) + total("b1", line) - total("b1", before) - F.col("b1")).alias("v1"),
        total("a0", line).alias("w0"),
        total("a1", line).alias("w1"),
    )
    variant = lambda v0, v1, n, cut: F.struct(
        F.col(v0).alias("v0"), F.col(v1).alias("v1"), n.alias("n"), cut.alias("cut")
    )
    cut = variant("v0", "v1", F.col("size") - 1, F.col("p") + 1)
    whole = variant("w0", "w1", F.col("size"), F.lit(0))
    both = F.when(F.col("p") == 0, F.array(cut, whole)).otherwise(F.array(cut))
    return run.select("k0", "k1", "first", F.inline(both))


def within_one_edit(a: Column, b: Column) -> Column:
    """Whether two arrays of words are at most one edit apart, by their common ends."""
    shorter, longer = F.least(F.size(a), F.size(b)), F.greatest(F.size(a), F.size(b))
    apart = F.zip_with(F.slice(a, 1, shorter), F.slice(b, 1, shorter), lambda x, y: x != y)
    ahead = F.array_position(apart, True) - 1  # equal words at the beginning
    ahead = F.when(ahead < 0, shorter).otherwise(ahead)
    rest = longer - shorter
    tail = lambda c: F.slice(c, ahead + 1 + F.when(F.size(c) == longer, 1).otherwise(1 - rest), F.size(c))
    return (rest <= 1) & (tail(a) == tail(b))


def _verify(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """The later lines of pairs that really are within one edit."""
    earlier = lines.select(F.col("first").alias("least"), F.col("words").alias("words_b"))
    return (
        pairs.join(lines.select("k0", "k1", F.col("words").alias("words_a")), ["k0", "k1"])
        .join(earlier, "least")
        .filter(within_one_edit(F.col("words_a"), F.col("words_b")))
        .select("k0", "k1")
        .distinct()
        .withColumn("near", F.lit(True))
    )


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text", counts: tuple[str, str] = ("n_lines", "n_removed")
) -> DataFrame:
    """The rows of ``docs`` with ``text`` without its repeated lines (see
    :func:`repeated_lines`), and n_lines and n_removed (named by ``counts``; columns of these
    names are replaced); all other columns are kept, whatever their names.

    A null text stays null (0 lines).  Rows without a key are left as they are.  Rows that
    share a key are one document: none of their lines at the same place is earlier than the
    other, also where their texts differ.  A text whose lines all go is empty.  An empty table
    gives no rows.
    """
    gone = stage(repeated_lines(docs, key, text).distinct(), "repeated-lines")
    # Texts without such a line are not shuffled.
    marked = _marked(_texts(docs, key, text), _filter_of(gone, "doc", "version"), "doc", "version")
    places = gone.groupBy("doc", "version").agg(F.collect_set("place").alias("gone"))
    whole = marked.filter("NOT maybe").select("row", "text", F.lit(None).cast("array<int>").alias("gone"))
    hit = marked.filter("maybe").join(places, ["doc", "version"], "left").select("row", "text", "gone")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line, i: ~F.array_contains("gone", i))
    n_lines, n_removed = counts
    names = [c for c in docs.columns if c not in counts]
    new = F.when(F.col("gone").isNotNull(), F.array_join(kept, "\n")).otherwise(F.col("text"))
    return whole.unionByName(hit).select(
        *[(new if c == text else F.col(f"row.`{c}`")).alias(c) for c in names],
        F.when(F.col("text").isNull(), 0).otherwise(F.size(lines)).cast("long").alias(n_lines),
        F.when(F.col("gone").isNotNull(), F.size("gone")).otherwise(0).cast("long").alias(n_removed),
    )
