"""Secret scans: format rules, and a battery of randomness tests.

Every maximal run of encoded characters has its encoding inferred (hexadecimal, base 32,
base 36, base 64), and is tested for coming from a uniform random source over that
alphabet: a chi-squared test of uniformity, a runs test about the middle of the alphabet,
and the correlation of neighbouring symbols.  Fisher's method combines the three.  Short
tokens give the tests little power, so false discovery is controlled separately
for each band of lengths (Benjamini-Hochberg over the whole corpus, on a logarithmic grid
of p-values): a token is called ordinary only where the share of random tokens among the
ones so called stays below ``fdr``.  What is not called ordinary is a secret.

Everything here is a DataFrame expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.blocks import free_name

# fixed values: kind, pattern, group that is measured, least length
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
BASE = [
    ("assign", ASSIGN, r"[A-Za-z0-9+/_.=-]+", 6),
    ("access", "", r"AKIA[A-Z0-9]{16,}+", 0),
    ("hex", "", r"[0-9a-f]{24,}+", 0),
]
TOKEN = r"[A-Za-z0-9+/_-]{20,}+=*+"      # "=" only ends a token: the value of key=value is a token of its own
# fixed values: encoding, shape, alphabet
ENCODINGS = [
    ("hex", r"^(?=.*[0-9])(?=.*[a-fA-F])([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    ("base32", r"^(?=.*[2-7])(?=.*[A-Z])[A-Z2-7]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", r"^(?=.*[0-9])(?=.*[a-zA-Z])([a-z0-9]+|[A-Z0-9]+)$", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("base64", r"^(?=.*[0-9])(?=.*[a-z])(?=.*[A-Z])[A-Za-z0-9+/_-]+=*$", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
]
BANDS = [24, 32, 40, 64, 128]       # a token's band is the number of these its length reaches
KINDS = ["assign", "access", "hex", "random"]
CHUNK = 256                         # matches that are numbered together (appending to an array copies it)
GRID, LEAST_BIN = 50, 2000          # p-values are counted at 1/50 of a natural logarithm, down to e^-40


def spans(text: Column, kind: str, before: str, body: str, least: int) -> Column:
    """Leftmost non-overlapping matches as structs (start, rank, end, kind, body), in code
    points.  Matches whose body is shorter than ``least`` are dropped afterwards."""
    # \G: each match begins where the last one ended, so the text is walked through once
    whole = rf"(?s)\G(.*?)({before})({body})"
    groups = [F.regexp_extract_all(text, F.lit(whole), F.lit(i)) for i in (1, 2, 3)]
    zipped = F.arrays_zip(*[g.alias(n) for g, n in zip(groups, ("gap", "head", "body"))])
    kind_type = "array<struct<start:int,rank:int,end:int,kind:string,body:string>>"

    def step(acc, m):
        begin = acc["at"] + F.length(m["gap"])
        end = begin + F.length(m["head"]) + F.length(m["body"])
        one = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"), F.lit(kind).alias("kind"), m["body"].alias("body"))
        return F.struct(end.alias("at"), F.concat(acc["found"], F.array(one)).alias("found"))

    def chunk(acc, matches):
        inner = F.aggregate(matches, F.struct(acc["at"].alias("at"), F.array().cast(kind_type).alias("found")), step)
        return let(inner, lambda i: F.struct(i["at"].alias("at"), F.concat(acc["found"], F.array(i["found"])).alias("found")))

    def chunks(matches):
        cut = F.transform(F.sequence(F.lit(0), F.greatest(F.size(matches) - 1, F.lit(0)), F.lit(CHUNK)), lambda i: F.slice(matches, i + 1, F.lit(CHUNK)))
        return F.aggregate(cut, F.struct(F.lit(0).alias("at"), F.array().cast(f"array<{kind_type}>").alias("found")), chunk, lambda acc: F.flatten(acc["found"]))

    found = let(zipped, chunks)
    found = F.when(text.rlike(before + body), found).otherwise(F.array().cast(kind_type))
    return F.filter(found, lambda s: F.length(s["body"]) >= least) if least else found


def base_spans(text: Column) -> Column:
    """All matches of the format rules, by start, then kind."""
    return F.array_sort(F.concat(*[spans(text, *rule) for rule in BASE]))


def let(value: Column, then) -> Column:
    """``then(value)``, with the value computed once however often it is used."""
    return F.transform(F.array(value), then)[0]


def tail(z: Column) -> Column:
    """Upper tail of the standard normal (logistic approximation, within 2e-4)."""
    return let(F.greatest(F.lit(-30.0), F.least(F.lit(30.0), z)), lambda z: 1 / (1 + F.exp(z * 1.5976 + z * z * z * 0.07056)))


def battery(token: Column, alphabet: str) -> Column:
    """Combined p-value of a token under a uniform random source over ``alphabet``."""
    size = len(alphabet)
    n = F.length(token).cast("double")
    counts = F.transform(F.array(*[F.lit(c) for c in alphabet]), lambda c: F.pow(F.length(token) - F.length(F.replace(token, c, F.lit(""))), F.lit(2)))
    chi = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x) * size / n - n
    uniformity = tail((chi - (size - 1)) / F.sqrt(2.0 * (size - 1) * (n - 1) / n))
    values = F.transform(F.split(token, ""), lambda c: (F.instr(F.lit(alphabet), c) - 1).cast("double"))

    def moments(values):
        """Sums over the symbols, in one pass: highs, runs, sum, squares, neighbours."""
        first = F.struct(*[F.lit(0.0).alias(x) for x in ("high", "runs", "sum", "square", "next")], F.lit(-1.0).alias("last"))

        def step(a, x):
            high = F.when(x >= size / 2, 1.0).otherwise(0.0)
            turned = F.when((a["last"] < 0) | ((a["last"] >= size / 2) != (x >= size / 2)), 1.0).otherwise(0.0)
            return F.struct((a["high"] + high).alias("high"), (a["runs"] + turned).alias("runs"), (a["sum"] + x).alias("sum"), (a["square"] + x * x).alias("square"),
                            (a["next"] + F.when(a["last"] < 0, 0.0).otherwise(a["last"] * x)).alias("next"), x.alias("last"))

        return F.aggregate(values, first, step)

    def runs_test(m, n):
        def about(expected):
            spread = F.sqrt(F.greatest((expected - 1) * (expected - 2) / (n - 1), F.lit(1e-9)))
            return F.least(F.lit(1.0), 2 * tail(F.abs((m["runs"] - expected) / spread)))

        return let(2 * m["high"] * (n - m["high"]) / n + 1, about)

    def serial_test(m, n):
        mean = m["sum"] / n
        about = lambda v: F.when(v <= 0, F.lit(0.0)).otherwise(
            F.least(F.lit(1.0), 2 * tail(F.abs((m["next"] / (n - 1) - mean * mean) / v * F.sqrt(n)))))
        return let(m["square"] / n - mean * mean, about)

    def combine(m):
        x = sum((-F.log(F.greatest(p, F.lit(1e-12))) for p in (uniformity, runs_test(m, n), serial_test(m, n))), F.lit(0.0))
        return let(x, lambda x: F.exp(-x) * (1 + x + x * x / 2))        # Fisher: chi-squared with six degrees of freedom

    return let(moments(values), combine)


def random_candidates(text: Column) -> Column:
    """Encoded tokens as structs (start, rank, end, kind, body, band, bin): the bin is
    -log p of the battery on the grid; null where no encoding fits."""
    def tested(s):
        body = F.rtrim(F.translate(s["body"], "-_=", "+/ "))
        p = F.lit(None).cast("double")
        for name, shape, alphabet in reversed(ENCODINGS):
            symbols = F.lower(body) if name in ("hex", "base36") else body
            p = F.when(s["body"].rlike(shape), battery(symbols, alphabet)).otherwise(p)
        size = s["end"] - s["start"]
        band = sum((F.when(size >= b, 1).otherwise(0) for b in BANDS), F.lit(0))
        score = F.least(F.lit(LEAST_BIN), F.floor(-F.log(p) * GRID).cast("int"))
        return F.struct(*[s[c].alias(c) for c in ("start", "rank", "end", "kind", "body")], band.alias("band"), score.alias("bin"))

    return F.filter(F.transform(spans(text, "random", "", TOKEN, 0), tested), lambda s: s["bin"].isNotNull())


def ordinary_bins(docs: DataFrame, fdr: float, text: str = "text") -> list[int]:
    """For each band of lengths, the bin from which tokens are called ordinary."""
    found = docs.select(F.explode(random_candidates(F.coalesce(F.col(text).cast("string"), F.lit("")))).alias("t"))
    bins = found.groupBy("t.band", "t.bin").agg(F.count("*").alias("n"))
    ordered = Window.partitionBy("band").orderBy(F.col("bin").desc())
    ranked = bins.select("band", "bin", F.sum("n").over(ordered).alias("rank"), F.sum("n").over(Window.partitionBy("band")).alias("all"))
    passing = ranked.where(F.exp(-F.col("bin") / GRID) <= F.col("rank") / F.col("all") * fdr)
    least = {r["band"]: r["bin"] for r in passing.groupBy("band").agg(F.min("bin").alias("bin")).collect()}
    return [least.get(b, LEAST_BIN + 1) for b in range(len(BANDS) + 1)]


def joined(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def with_secret_spans(docs: DataFrame, fdr: float = 0.05, text: str = "text", into: str = "secret_spans") -> DataFrame:
    """``docs`` and a column of all spans (start, rank, end, kind), base ones and random tokens.

    A random token inside a base span is not repeated.  Offsets are code points of the
    text, the end exclusive.
    """
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    least = F.array(*[F.lit(x) for x in ordinary_bins(docs, fdr, text)])
    plain = lambda s: F.struct(*[s[c].alias(c) for c in ("start", "rank", "end", "kind")])
    base = F.transform(base_spans(body), plain)

    def added(base):
        secret = F.filter(random_candidates(body), lambda s: (s["bin"] < F.element_at(least, s["band"] + 1))
                          & ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"])))
        return F.array_sort(F.concat(base, F.transform(secret, plain)))

    return docs.withColumn(into, let(base, added))


def find_secrets(docs: DataFrame, fdr: float = 0.05, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_assign, n_access, n_hex, n_random, base_sha256, spans``.

    ``spans`` lists ``kind:start:end`` by start, then kind.  Null and empty texts have
    none; a null ``doc_id`` is returned as null; repeated rows are scanned alike (and each
    counts in the control of false discovery); an empty table gives no rows; other
    columns are ignored.  Long texts and tokens are read whole, in time that grows with their length.
    """
    rows = with_secret_spans(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), fdr, "text", "found")
    n = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = joined(F.filter("found", lambda s: s["kind"] != "random"))
    return rows.select("doc_id", *[n(k) for k in KINDS], F.sha2(base.cast("binary"), 256).alias("base_sha256"), joined(F.col("found")).alias("spans"))


def redact(docs: DataFrame, fdr: float = 0.05, text: str = "text", mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every secret in ``text`` replaced by ``mark`` (overlapping ones by one).
    Null texts stay null; a text is read once for each of its secrets."""
    whole, spans_at = F.col(text), free_name(docs, "_secret_spans")
    first = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def step(a, s):
        gap = F.concat(a["out"], F.substr(whole, a["at"] + 1, s["start"] - a["at"]), F.lit(mark))
        return F.when(s["start"] >= a["at"], F.struct(gap.alias("out"), s["end"].alias("at"))).otherwise(
            F.struct(a["out"].alias("out"), F.greatest(a["at"], s["end"]).alias("at")))

    clean = F.aggregate(spans_at, first, step, lambda a: F.concat(a["out"], F.substr(whole, a["at"] + 1, F.length(whole))))
    rows = with_secret_spans(docs, fdr, text, spans_at)
    return rows.withColumn(text, F.when(F.size(spans_at) > 0, clean).otherwise(whole)).drop(spans_at)
