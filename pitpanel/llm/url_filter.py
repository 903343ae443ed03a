"""URL filter: host and path rules, then a weighted vocabulary of terms.

An Aho-Corasick automaton over the lower-cased URL finds the terms of the vocabulary; a
hit counts only where no ASCII letter or digit touches it.  One strict term, or
``soft_needed`` different soft terms, reject.  The automaton is built once for each
Python worker; its size is that of the vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed values: (verdict, host, path)
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# fixed values: one of these is enough
STRICT = ["porn", "porno", "pornhub", "xxx", "nsfw", "hentai", "camgirl", "camgirls", "milf", "escorts", "sextape", "warez",
          "keygen", "malware", "phishing", "ransomware", "spam", "linkfarm"]
# fixed values: several different ones are needed
SOFT = ["adult", "sex", "sexy", "nude", "naked", "erotic", "fetish", "webcam", "dating", "casino", "poker", "betting", "bet", "slots",
        "jackpot", "lottery", "viagra", "cialis", "pills", "pharmacy", "cheap", "free", "download", "torrent", "crack", "serial", "loan",
        "payday", "farm", "clickbait", "proxy", "hack"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url):
    """Host of a URL: after the first ``://``, up to ``/``, ``?``, ``#`` or the end."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url):
    """Path of a URL: what follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host, path, rules):
    """Index of the longest rule that fits (the first of equally long ones); null if none does."""
    out = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: (len(rules[i][1] + rules[i][2]), -i)):
        _, h, p = rules[i]
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.lit(i)).otherwise(out)
    return out


def count_terms(strict: Sequence[str], soft: Sequence[str]):
    """A function that counts the different strict and soft terms of URLs."""
    made = []

    def automaton():
        if not made:
            a = ahocorasick.Automaton()
            for kind, terms in (("strict", strict), ("soft", soft)):
                for t in terms:
                    a.add_word(t, (kind, t))
            a.make_automaton()
            made.append(a)
        return made[0]

    def one(url: str | None) -> tuple[int, int]:
        if not url:
            return 0, 0
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url)
        word = lambda i: 0 <= i < len(low) and low[i].isascii() and low[i].isalnum()
        hits = {hit for end, hit in automaton().iter(low) if not word(end + 1) and not word(end - len(hit[1]))}
        n = sum(kind == "strict" for kind, _ in hits)
        return n, len(hits) - n

    def counts(urls: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(u) for u in urls], columns=["n_strict", "n_soft"], dtype="int64")

    return F.pandas_udf(counts, "n_strict long, n_soft long")


def judge_urls(pages: DataFrame, rules=RULES, strict: Sequence[str] = STRICT, soft: Sequence[str] = SOFT, soft_needed: int = 2,
               page_id: str = "page_id", url: str = "url") -> DataFrame:
    """One row per input row: ``page_id, host, path, rule, verdict, n_strict, n_soft``.

    ``verdict`` is that of the longest rule that fits, else ``block`` for one strict
    or ``soft_needed`` different soft terms, else ``allow``.  A rule fits its host and
    all subdomains if the path starts with the rule's path.

    A null URL, or one without ``://``, has an empty host and path (terms of the latter
    still count); a null id is returned as null; repeated rows are judged alike; an empty
    table gives no rows; other columns are ignored.
    """
    rows = pages.select(F.col(page_id).alias("page_id"), F.col(url).cast("string").alias("url"))
    rows = rows.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"),
                       count_terms(tuple(strict), tuple(soft))("url").alias("terms"))
    rows = rows.withColumn("rule_at", longest_rule(F.col("host"), F.col("path"), rules))
    named, judged = F.lit(None).cast("string"), F.lit(None).cast("string")
    for i, (verdict, h, p) in enumerate(rules):
        named = F.when(F.col("rule_at") == i, F.lit(h + p)).otherwise(named)
        judged = F.when(F.col("rule_at") == i, F.lit(verdict)).otherwise(judged)
    bad = (F.col("terms.n_strict") > 0) | (F.col("terms.n_soft") >= soft_needed)
    return rows.select("page_id", "host", "path", named.alias("rule"), F.coalesce(judged, F.when(bad, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
                       F.col("terms.n_strict").alias("n_strict"), F.col("terms.n_soft").alias("n_soft"))
