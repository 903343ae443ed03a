"""SpotSigs document fingerprints.

A signature is an anchor (a common word) and the chain of the next content words after
it, other common words skipped.  A document's fingerprint is its set of signatures, each as
the 8 hex digits of a hash, in order.  Two fingerprints are compared by their Jaccard
coefficient.  For a threshold ``t`` two sets can only be alike if the smaller has at least ``t``
times the larger one's size, so sets are partitioned by length (powers of ``1 / t``) and meet
only within a partition and with the next one, on the rarest of their signatures.

Everything here is a DataFrame expression.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.session import materialize

# fixed values: common words of English, German, French and Spanish
ANCHORS = """a an and are as at be by for from he in is it of on or she that the they this to was were with
der die das den dem ein eine ist im mit nicht sich und von zu auf
le la les un une de des du en est et que qui dans pour pas
el los las una del es y por con no se""".split()
BUCKET_ROWS, BUCKETS = 500, 200_000


def normal(text: Column) -> Column:
    """Lower-case words (letters and digits) between single spaces, one at each end."""
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def one_of(words: list[str]) -> str:
    """Pattern for any of the words that shares their beginnings, so that a text is
    compared with few alternatives."""
    ends, tails = "" in words, sorted({w for w in words if w})
    branches = [c + one_of([w[1:] for w in tails if w[0] == c]) for c in sorted({w[0] for w in tails})]
    if not branches:
        return ""
    return "(?:" + "|".join(branches) + ")" + ("?" if ends else "")


def signatures(text: Column, anchors=ANCHORS) -> Column:
    """Distinct signatures of a text, hashed to ints, in order.  A text without any has one:
    that of its words (so that equal texts are always alike)."""
    words = normal(text)
    # mark the common words; then the two next words without a mark are the chain
    marked = F.regexp_replace(words, rf" (?={one_of(list(anchors))} )", " \u0001")
    skip = "(?: \u0001[^ ]+)*+"
    spot = rf"\u0001([^ ]+)(?={skip} ([^ ]+){skip} ([^ ]+) )"

    def chains(m):
        zipped = F.arrays_zip(*[F.regexp_extract_all(m, F.lit(spot), F.lit(g)).alias(n) for g, n in ((1, "anchor"), (2, "one"), (3, "two"))])
        return F.transform(zipped, lambda c: F.hash(c["anchor"], c["one"], c["two"]))

    found = F.transform(F.array(marked), chains)[0]
    either = lambda f: F.when(F.size(f) > 0, f).otherwise(F.array(F.hash(F.lit("="), words)))
    return F.transform(F.array(found), lambda f: F.sort_array(F.array_distinct(either(f))))[0]


def fingerprint(signs: Column) -> Column:
    """Text form of a signature set."""
    return F.array_join(F.transform(signs, lambda s: F.lpad(F.lower(F.hex(s.cast("long").bitwiseAND(F.lit(0xFFFFFFFF)))), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two signature sets."""
    both = F.size(F.array_intersect(a, b))
    return F.when(a == b, F.lit(1.0)).otherwise(both / (F.size(a) + F.size(b) - both))


def wide(c) -> Column:
    """A long where sums and differences of longs don't overflow."""
    return c.cast("decimal(20,0)")


def steps(value: Column, width: Column) -> Column:
    """How many whole widths a value holds."""
    return F.call_function("div", value, wide(width))


def start_of(ids: Column, low: Column, high: Column, parts: Column) -> Column:
    """Start of an id's range, where ``low .. high`` is cut into ``parts`` (2 or more) even ranges."""
    width = wide(steps(wide(high) - wide(low), parts)) + 1
    return (wide(low) + wide(steps(wide(ids) - wide(low), width)) * width).cast("long")


def dealt(docs: DataFrame, each: int, rows: int, n: int, low: int | None, high: int | None) -> DataFrame:
    """``docs`` (with ``doc_id, hash``) and their bucket: ``known, at, part``.

    Descending buckets hold descending ids, nulls last.  Ids are cut into even ranges, and
    a range that holds much more than ``each`` rows is cut again between its least and
    largest id until none does, so ids may lie as unevenly as they like; a single crowded
    id is cut by its rows' hashes.  A level's crowded ranges are ``rows / (4 * each)`` at
    most, so their table can be broadcast.
    """
    parts = lambda n: F.ceil(n / F.lit(each)).cast("long")
    known = F.col("doc_id").isNotNull()
    nulls = F.pmod("hash", F.lit(max(1, -(-(rows - n) // each))))
    at = start_of(F.col("doc_id"), F.lit(low), F.lit(high), F.lit(max(2, -(-n // each)))) if n else F.lit(0)
    out = docs.withColumn("known", known).withColumn("at", F.when(known, at).otherwise(nulls).cast("long"))
    crowded = None
    while n:
        ranges = out.where("known").groupBy("known", "at").agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        crowded = materialize(ranges.where(F.col("n") > 4 * each), "crowded")
        cut = crowded.where("low < high").withColumn("n", parts(F.col("n")))
        if cut.isEmpty():
            break
        finer = F.when(F.col("n").isNull(), F.col("at")).otherwise(start_of(F.col("doc_id"), F.col("low"), F.col("high"), F.col("n")))
        out = out.join(F.broadcast(cut), ["known", "at"], "left").withColumn("at", finer).drop("n", "low", "high")
    if crowded is None or crowded.isEmpty():
        return out.withColumn("part", F.lit(0).cast("long"))
    out = out.join(F.broadcast(crowded.select("known", "at", parts(F.col("n")).alias("n"))), ["known", "at"], "left")
    share = wide(F.call_function("div", F.lit(1 << 62), F.col("n"))) * 4 + 4
    part = F.call_function("div", wide(F.col("hash")) + F.lit(1 << 62).cast("decimal(20,0)") * 2, share)
    return out.withColumn("part", F.when(F.col("n").isNull(), F.lit(0)).otherwise(part).cast("long")).drop("n")


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` (``doc_id, text`` and others) and the ``columns`` of the next row in
    descending order of ``doc_id`` (equal ids by text; null ids last; the first
    row after the last), named ``next_*``."""
    low, high, n, rows = docs.agg(F.min("doc_id"), F.max("doc_id"), F.count("doc_id"), F.count("*")).first()
    each = max(BUCKET_ROWS, -(-rows // BUCKETS))
    key = ["known", "at", "part"]
    here = dealt(docs.withColumn("hash", F.bitwise_not(F.xxhash64("text"))), each, rows, n, low, high)
    # the first row of every bucket: as many as buckets, so they can be broadcast to find their texts
    tops = materialize(here.groupBy(*key).agg(F.max(F.struct("doc_id", "hash")).alias("top")), "tops")
    heads = here.join(F.broadcast(tops), key).where(F.col("doc_id").eqNullSafe(F.col("top.doc_id")) & (F.col("hash") == F.col("top.hash")))
    heads = heads.drop("top").dropDuplicates(key)
    # a copy of it closes the bucket before, where the window can see it
    down = Window.orderBy(*[F.col(c).desc() for c in key])
    after = tops.select(F.struct(*key).alias("own"), F.coalesce(F.lead(F.struct(*key)).over(down), F.first(F.struct(*key)).over(down)).alias("then"))
    closing = heads.join(F.broadcast(after), F.struct(*key) == F.col("then")).drop(*key, "then").select("*", "own.*").drop("own")
    rows = here.withColumn("copy", F.lit(False)).unionByName(closing.withColumn("copy", F.lit(True)))
    order = Window.partitionBy(*key).orderBy("copy", F.col("doc_id").desc_nulls_last(), F.col("hash").desc(), "text")
    out = rows.withColumn("ahead", F.lead(F.struct(*columns)).over(order)).where("not copy")
    return out.select(*docs.columns, *[F.col(f"ahead.{c}").alias(f"next_{c}") for c in columns])


def edited_fingerprints(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next``.

    The edited text has the last floor(``n_chars`` / 2) code points replaced by the first as
    many (or all) of the next document's.  ``near_*`` are Jaccard coefficients.

    Null and empty texts are empty; they, and texts without an anchor, have one
    signature, that of all their words.  Rows with equal ids follow each other in
    order of their texts' hashes; null ids come last; a lone row follows itself; an empty
    table gives no rows; other columns are ignored.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), body.alias("text"))
    rows = rows.withColumn("signs", signatures(F.col("text")))
    rows = with_next(rows, ["text", "signs"])
    n = F.length("text")
    half = F.floor(n / 2).cast("int")
    rows = rows.select("*", n.cast("long").alias("n_chars"), F.concat(F.substr("text", F.lit(1), n - half), F.substr("next_text", F.lit(1), half)).alias("edited"))
    rows = rows.withColumn("edited_signs", signatures(F.col("edited")))
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), fingerprint(F.col("signs")).alias("fingerprint"),
                       fingerprint(F.col("edited_signs")).alias("edited_fingerprint"),
                       likeness(F.col("signs"), F.col("edited_signs")).alias("near_edited"), likeness(F.col("signs"), F.col("next_signs")).alias("near_next"))


def similar_fingerprints(docs: DataFrame, threshold: float = 0.8, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Near-duplicates by pruned Jaccard: membership ``doc_id, class_id`` (the least id
    with the same signature set), and pairs ``a, b, likeness`` of classes.

    Each distinct set is indexed by the rarest of its signatures only (as many as two
    sets of the given likeness must share one of); sets meet within a partition of
    lengths and with the next.  Null ids and null texts take part; a class of null ids
    only has no id and no pairs.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = materialize(docs.select(F.col(doc_id).cast("long").alias("doc_id"), signatures(body).alias("signs")), "spotsigs")
    classes = materialize(rows.groupBy("signs").agg(F.min("doc_id").alias("class_id")).where("class_id is not null"), "spot-classes")
    signs = classes.select("class_id", F.size("signs").alias("n"), F.explode("signs").alias("sign"))
    rare = signs.groupBy("sign").agg(F.count("*").alias("df"))
    ranked = signs.join(rare, "sign").groupBy("class_id", "n").agg(F.array_sort(F.collect_list(F.struct("df", "sign"))).alias("order"))
    keep = F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1
    step = math.log(1 / threshold)
    keys = ranked.select("class_id", "n", F.floor(F.log(F.col("n").cast("double")) / step + 1e-9).alias("length"), F.explode(F.slice("order", F.lit(1), keep.cast("int"))).alias("o"))
    left = keys.select(F.col("class_id").alias("a"), F.col("n").alias("n_a"), "length", F.col("o.sign").alias("sign"))
    right = keys.select(F.col("class_id").alias("b"), F.col("n").alias("n_b"), F.explode(F.array(F.col("length"), F.col("length") - 1, F.col("length") + 1)).alias("length"), F.col("o.sign").alias("sign"))
    met = left.join(right, ["length", "sign"]).where("a < b").where(F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * threshold - 1e-9).select("a", "b").distinct()
    sets = classes.select("class_id", "signs")
    pairs = met.join(sets.toDF("a", "x"), "a").join(sets.toDF("b", "y"), "b").select("a", "b", likeness(F.col("x"), F.col("y")).alias("likeness"))
    return rows.join(classes, "signs").select("doc_id", "class_id"), pairs.where(F.col("likeness") >= threshold)
