"""Mixing sources to target weights with soft membership.

A classifier learned from labelled rows gives every document a posterior over the domains.
Rates ``r >= 0`` (expected copies of each document) then minimise ::

    sum_k w_k ((S_k - T_k) / N)^2 / 2 + ridge * sum_d n_d (r_d - 1)^2 / (2 N),   S_k = sum_d r_d n_d p_dk

where ``n_d`` are a document's tokens, ``N`` all tokens, ``T_k`` the target totals and ``w_k``
is ``N`` by the tokens of domain ``k`` at rates of 1, so that rare domains move as fast as
frequent ones (steps of 1 still converge: the rows of the scaled Hessian sum to 1).  The
solver is accelerated projected gradient in the metric ``n_d``: a step moves every rate by
``p_d . w (S - T) / N`` and cuts it at zero.  A document's rate is a function of its posterior
and of the gradients so far, so an iteration is one scan of the posteriors that sums one
number for each domain.  After ``SEGMENT`` iterations the rates reached are written beside the
posteriors, so an iteration replays that many steps at most.  The solver goes on until
the totals meet the targets; where they come no nearer the ridge is lowered, and where they
still do not, the least squares solution found is returned with what it misses.

The classifier is naive Bayes over hashed words.  A domain's word shares are smoothed by the
shares of all domains together (``strength`` pseudo-tokens), so a small domain falls
back to the whole sample and not to equal shares of all features.  Words of a text are not
independent: the mean evidence of its ``n`` words counts ``temperature * n ** power`` times,
the pair of least log loss on held-out labelled rows (every fifth of a domain, not fitted on).

The classifier is fitted on a bounded sample of the labelled rows: ``per_domain`` documents of
each domain, those with the least hash of their id.  Every domain of the labelled rows is
learned, ``max_domains`` of them at a time; a target for any other is an error.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitpanel.llm.blocks import free_name
from pitpanel.llm.decontaminate import groups
from pitpanel.llm.hashing import LOWER, NOT_LETTERS, word_hashes
from pitpanel.session import materialize

U = np.uint64
FEATURES = 1 << 16
HELD_OUT = 5                    # one of so many labelled rows of a domain is held out
BROADCAST_ROWS = 2_000_000      # most sampled ids that are broadcast
SEGMENT = 16                    # iterations between writes of the rates
# the (temperature, power) pairs that are tried, the most cautious first
SCALES = [(2.0 ** (t / 2), power) for power in (0.0, 0.25, 0.5, 0.75, 1.0) for t in range(-8, 17)]
UNCALIBRATED = (1.0, 0.0)       # without a held-out row, a text brings the evidence of one word


def features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashed words of texts, end to end, and each text's first word."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    keys, _, _, firsts = word_hashes(LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)], bounds, NOT_LETTERS)
    return (keys >> U(48)).astype(np.int64), firsts


@dataclass
class Classifier:
    """Domains, log prior and, for each ``max_domains`` of them, evidence (feature x domain)
    of the hashed words; the scale of a text's evidence, and the held-out rows."""
    names: list[str]
    prior: np.ndarray
    tables: list[np.ndarray]
    scale: tuple[float, float]
    held_out: DataFrame | None


def sampled(docs: DataFrame, labelled: DataFrame, domain: str, per_domain: int) -> tuple[dict[str, int], DataFrame]:
    """Labelled rows of each domain, and the sample ``domain, held_out, text``."""
    ids = labelled.select(F.col("doc_id").cast("long").alias("doc_id")).where("doc_id is not null").distinct()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(domain).cast("string").alias("domain"),
                       F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text")).where("domain is not null")
    known = materialize(rows.drop("text").join(ids, "doc_id").groupBy("domain", "doc_id", "mark").agg(F.count("*").alias("n")), "domains")
    found = known.groupBy("domain").agg(F.sum("n").alias("n"), F.count("*").alias("texts")).collect()
    sizes = {r["domain"]: r["n"] for r in found}
    # hashes are uniform: a few times the wanted share of them holds the least ones, and only these are ranked
    bound = [(r["domain"], min(int(4 * (per_domain + 25) / r["texts"] * 2 ** 64), 2 ** 64 - 1) - 2 ** 63) for r in found]
    bounds = F.broadcast(docs.sparkSession.createDataFrame(bound, "domain string, bound long"))     # a row for each domain
    near = known.join(bounds, "domain").where(F.xxhash64("doc_id") <= F.col("bound"))
    least = Window.partitionBy("domain").orderBy(F.xxhash64("doc_id"), "doc_id", "mark")
    chosen = near.select("domain", "doc_id", "mark", F.row_number().over(least).alias("rank")).where(F.col("rank") <= per_domain)
    if len(sizes) * per_domain <= BROADCAST_ROWS:
        chosen = F.broadcast(chosen)
    sample = rows.join(chosen, ["domain", "doc_id", "mark"]).dropDuplicates(["domain", "doc_id", "mark"])
    return sizes, materialize(sample.select("domain", (F.col("rank") % HELD_OUT == 0).alias("held_out"), "text"), "sample")


def train(docs: DataFrame, labelled: DataFrame, domain: str, per_domain: int, max_domains: int, strength: float) -> Classifier:
    """The classifier of the labelled rows; without any it has no domains."""
    sizes, sample = sampled(docs, labelled, domain, per_domain)
    names = sorted(sizes)
    if not names:
        return Classifier([], np.zeros(0), [], UNCALIBRATED, None)
    size = np.array([sizes[name] for name in names], dtype=float)
    tables = [counted(sample.where("not held_out"), names[a:a + max_domains]) for a in range(0, len(names), max_domains)]
    shared = sum(t.sum(axis=1, dtype=float) for t in tables)
    seen = shared > 0
    shared = (shared[seen] / shared.sum())[:, None]
    for table in tables:
        tokens = table.sum(axis=0, dtype=float)
        table[seen] = np.log((table[seen] + strength * shared) / (tokens + strength) / shared)
    held_out = sample.where("held_out").drop("held_out")
    prior = np.log(size / size.sum())
    return Classifier(names, prior, tables, calibrated(held_out, names, prior, tables), held_out)


def counted(sample: DataFrame, names: list[str]) -> np.ndarray:
    """Counts (feature x domain) of the hashed words, for some domains."""
    number = {name: k for k, name in enumerate(names)}

    def count(batches):
        out = np.zeros(len(number) * FEATURES, dtype=np.int64)
        for batch in batches:
            texts = [t or b"" for t in batch.column(1).to_pylist()]
            k = np.array([number[d] for d in batch.column(0).to_pylist()], dtype=np.int64)
            for a, b in groups(texts):
                at, firsts = features(texts[a:b])
                np.add.at(out, at * len(number) + np.repeat(k[a:b], np.diff(firsts)), 1)
        some = np.flatnonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(out[some])], names=["at", "n"])

    rows = sample.where(F.col("domain").isin(names)).select("domain", "text")
    got = rows.mapInArrow(count, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(len(names) * FEATURES, dtype=np.float32)
    counts[got["at"].to_numpy()] = got["n"].to_numpy()
    return counts.reshape(FEATURES, len(names))


def mean_evidence(texts: list[bytes], tables: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and their mean evidence for each domain (no words: 0)."""
    at, firsts = features(texts)
    size = np.diff(firsts)
    out = np.zeros((len(texts), sum(t.shape[1] for t in tables)))
    some = np.flatnonzero(size)
    if len(some):
        out[some] = np.concatenate([np.add.reduceat(t[at], firsts[some], axis=0, dtype=float) for t in tables], axis=1) / size[some][:, None]
    return size, out


def softmax(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def calibrated(held_out: DataFrame, names: list[str], prior: np.ndarray, tables: list[np.ndarray]) -> tuple[float, float]:
    """The scale of least log loss on the held-out rows, weighted to the prior."""
    shared = [held_out.sparkSession.sparkContext.broadcast(t) for t in tables]
    number = {name: k for k, name in enumerate(names)}

    def losses(batches):
        loss, rows = np.zeros((len(number), len(SCALES))), np.zeros(len(number))
        for batch in batches:
            domains, texts = batch.column(0).to_pylist(), [t or b"" for t in batch.column(1).to_pylist()]
            for a, b in groups(texts):
                size, mean = mean_evidence(texts[a:b], [t.value for t in shared])
                k = np.array([number[d] for d in domains[a:b]])
                np.add.at(rows, k, 1)
                for i, (temperature, power) in enumerate(SCALES):
                    p = softmax(prior + mean * (temperature * size ** power)[:, None])
                    np.add.at(loss[:, i], k, -np.log(np.maximum(p[np.arange(len(k)), k], 1e-300)))
        some = np.flatnonzero(rows)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(rows[some]), pa.array(loss[some].tolist(), pa.list_(pa.float64()))], names=["k", "n", "loss"])

    one = held_out.select("domain", "text").mapInArrow(losses, "k long, n double, loss array<double>")
    sums = one.select("k", "n", F.posexplode("loss")).groupBy("k", "pos").agg(F.sum("n").alias("n"), F.sum("col").alias("loss")).collect()
    total = np.zeros(len(SCALES))
    for r in sums:
        total[r["pos"]] += np.exp(prior[r["k"]]) * r["loss"] / r["n"]
    return SCALES[int(total.argmin())] if sums else UNCALIBRATED


def membership(text, model: Classifier, spark):
    """Column ``struct<n_tokens, posterior>`` of a text column."""
    shared = [spark.sparkContext.broadcast(t) for t in model.tables]
    prior, (temperature, power) = model.prior, model.scale

    @F.arrow_udf("struct<n_tokens: bigint, posterior: array<double>>")
    def score(column: pa.Array) -> pa.Array:
        texts = [t or b"" for t in column.to_pylist()]
        n, p = [np.zeros(0, dtype=np.int64)], [np.zeros((0, len(prior)))]
        for a, b in groups(texts):
            size, mean = mean_evidence(texts[a:b], [t.value for t in shared])
            n.append(size)
            p.append(softmax(prior + mean * (temperature * size ** power)[:, None]))
        n, p = np.concatenate(n).astype(np.int64), np.concatenate(p)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(n) + 1, dtype=np.int32) * len(prior)), pa.array(p.ravel()))
        return pa.StructArray.from_arrays([pa.array(n), lists], names=["n_tokens", "posterior"])

    return score(text.cast("binary"))


def calibration(docs: DataFrame, labelled: DataFrame, domain: str = "lang", per_domain: int = 400, max_domains: int = 64, strength: float = 500.0) -> DataFrame:
    """How far posteriors hold on the held-out labelled rows: ``bin, n, confidence,
    accuracy`` for each tenth of the greatest posterior.  No held-out rows: no rows."""
    model = train(docs, labelled, domain, per_domain, max_domains, strength)
    if model.held_out is None:
        return docs.sparkSession.createDataFrame([], "bin int, n long, confidence double, accuracy double")
    rows = model.held_out.select("domain", membership(F.col("text"), model, docs.sparkSession)["posterior"].alias("posterior"))
    best = rows.select("domain", F.array_max("posterior").alias("p"), domain_of(model.names).alias("called"))
    return best.groupBy(F.least(F.lit(9), F.floor(F.col("p") * 10)).cast("int").alias("bin")).agg(
        F.count("*").alias("n"), F.avg("p").alias("confidence"), F.avg((F.col("called") == F.col("domain")).cast("int")).alias("accuracy"))


def domain_of(names: list[str]):
    """The domain of the greatest posterior (ties: the first by name)."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), F.array_position("posterior", F.array_max("posterior")).cast("int"))


def replay(p: np.ndarray, history: list, rate=None, ahead=None) -> tuple[np.ndarray, np.ndarray]:
    """Rates and extrapolated rates after some steps (a list of (gradient, momentum, ridge))
    from those given, or from 1."""
    rate = np.ones(len(p)) if rate is None else rate
    ahead = rate if ahead is None else ahead
    for gradient, momentum, ridge in history:
        new = np.maximum(0, ahead - (p @ gradient + ridge * (ahead - 1)) / (1 + ridge))
        ahead = new + momentum * (new - rate)
        rate = new
    return rate, ahead


def column(batch: pa.RecordBatch, name: str, k: int) -> np.ndarray:
    values = batch.column(batch.schema.get_field_index(name))
    return np.array(values.flatten()).reshape(-1, k)


def reached(batch: pa.RecordBatch, past: tuple, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posteriors, tokens, rates and extrapolated rates of a batch, ``past`` steps after the rates written in it."""
    p, n = column(batch, "posterior", k), np.array(batch.column(0), dtype=float)
    stored = [np.array(batch.column(i)) for i in (2, 3)] if batch.num_columns > 2 else []
    return p, n, *replay(p, past, *stored)


def domain_sums(rows: DataFrame, past: tuple, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Expected tokens of each domain at the rates and at the extrapolated rates."""
    def sums(batches):
        out = np.zeros((2, k))
        for batch in batches:
            p, n, rate, ahead = reached(batch, past, k)
            out += [(rate * n) @ p, (ahead * n) @ p]
        yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(out[0]), pa.array(out[1])], names=["k", "at_rate", "at_ahead"])

    got = sorted(rows.mapInArrow(sums, "k int, at_rate double, at_ahead double").groupBy("k").agg(F.sum("at_rate"), F.sum("at_ahead")).collect())
    out = np.zeros((2, k))
    for i, at_rate, at_ahead in got:
        out[:, i] = at_rate, at_ahead
    return out[0], out[1]


def advanced(rows: DataFrame, past: tuple, k: int) -> DataFrame:
    """``rows`` with the rates reached written beside the posteriors."""
    def step(batches):
        for batch in batches:
            _, _, rate, ahead = reached(batch, past, k)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rate), pa.array(ahead)], names=["n_tokens", "posterior", "rate", "ahead"])

    return materialize(rows.mapInArrow(step, "n_tokens long, posterior array<double>, rate double, ahead double"), "rates")


def fit_rates(rows: DataFrame, shares: np.ndarray, ridge: float, rounds: int, tolerance: float) -> tuple[list, float]:
    """The steps after which each domain's share of the expected tokens is ``shares``,
    and by how much of all tokens the worst domain misses.

    ``rows`` has ``n_tokens, posterior``.  Where the totals stay off, the ridge is lowered twice, a hundredfold each
    time; each ridge is left when the totals stand still (three changes below a
    twentieth of the tolerance) or came no nearer by 1 % in ``rounds`` steps.
    """
    k = len(shares)
    rows = rows.select("n_tokens", "posterior")
    size, _ = domain_sums(rows, (), k)
    total = size.sum()
    if not total:
        return [], 0.0
    targets, allowed = shares * total, tolerance * total / k
    weight = total / np.maximum(size, 1e-9 * total)
    history, written = [], 0
    before = at_rate = at_ahead = size
    for level in (ridge, ridge / 100, ridge / 10000):
        t, best, since, still, last = 1.0, np.inf, 0, 0, np.inf
        while True:
            off = np.abs(at_rate - targets).max()
            if off <= allowed:
                return history, off / total
            still = still + 1 if history and np.abs(at_rate - before).max() <= 0.05 * allowed else 0
            best, since = (off, 0) if off < 0.99 * best else (best, since + 1)
            if still >= 3 or since >= rounds:
                break
            miss = (weight * (at_rate - targets) ** 2).sum()
            t = 1.0 if miss > last else t           # momentum went too far: begin anew
            last = miss
            after = (1 + (1 + 4 * t * t) ** 0.5) / 2
            history.append((weight * (at_ahead - targets) / total, (t - 1) / after, level))
            t = after
            if len(history) - written == SEGMENT:
                rows, written = advanced(rows, tuple(history[written:]), k), len(history)
            before = at_rate
            at_rate, at_ahead = domain_sums(rows, tuple(history[written:]), k)
    return history, off / total


def with_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, domain: str = "lang", per_domain: int = 400,
               max_domains: int = 64, strength: float = 500.0, ridge: float = 1e-3, rounds: int = 30, tolerance: float = 0.01,
               keep: list[str] | None = None) -> DataFrame:
    """``docs`` with columns ``n_tokens, domain, posterior, rate, residual``, one row per input row.

    ``docs`` has ``doc_id, text`` and the ``domain`` column; ``labelled`` names by ``doc_id``
    the documents whose domain is learned from.  ``targets`` maps domains to weights
    (default: equal); the expected tokens of each domain, at the returned rates, make up
    its share of all tokens, within ``tolerance`` of an equal share.  ``residual``, alike in all rows, is the share of all tokens by which
    the worst domain misses its target: targets that no rates meet (equal texts under
    two labels) get the least squares solution.  ``posterior`` is in alphabetical order of the domains.
    ``keep`` names the input columns to return (default: all); one that has
    the name of a new column is returned with ``_input`` added.

    Null and empty texts have no tokens, the prior as posterior, and a rate like any
    other; long texts are read whole; null domains are not learned from; a null ``doc_id`` is returned as null;
    repeated rows get equal rates, and count once in the fit of the classifier.  Without a labelled row the domain is null, the
    posterior empty, every rate 1 and the residual 0.  An empty table gives no rows.  A target for a domain
    that no labelled row has is an error.
    """
    new = ["n_tokens", "domain", "posterior", "rate", "residual"]
    names = {c: free_name(docs, c + "_input") if c.lower() in new else c for c in (docs.columns if keep is None else keep)}
    quoted = {c: F.col("`" + c.replace("`", "``") + "`") for c in names}
    model = train(docs, labelled, domain, per_domain, max_domains, strength)
    unknown = sorted(n for n, w in (targets or {}).items() if w > 0 and n not in model.names)
    if unknown:
        raise ValueError(f"targets for domains that no labelled row has: {', '.join(unknown)}")
    if not model.names:
        size = F.size(F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), r"[^\p{L}\p{N}]+"), "")).cast("long")
        return docs.select(*[quoted[c].alias(n) for c, n in names.items()], size.alias("n_tokens"), F.lit(None).cast("string").alias("domain"),
                           F.array().cast("array<double>").alias("posterior"), F.lit(1.0).alias("rate"), F.lit(0.0).alias("residual"))
    found = free_name(docs, "_membership")
    kept = docs.select(*[quoted[c].alias(n) for c, n in names.items()], membership(F.col("text"), model, docs.sparkSession).alias(found))
    rows = materialize(kept.select(*[F.col("`" + n.replace("`", "``") + "`") for n in names.values()], f"{found}.*"), "posteriors")
    weight = np.array([max(0.0, float((targets or {}).get(n, 0.0 if targets else 1.0))) for n in model.names])
    history, residual = fit_rates(rows, weight / (weight.sum() or 1.0), ridge, rounds, tolerance)
    k = len(model.names)

    @F.arrow_udf("double")
    def rate(posterior: pa.Array) -> pa.Array:
        return pa.array(replay(np.array(posterior.flatten()).reshape(-1, k), history)[0])

    return rows.withColumns({"domain": domain_of(model.names), "rate": rate("posterior"), "residual": F.lit(float(residual))}).select(
        *[F.col("`" + n.replace("`", "``") + "`") for n in names.values()], *new)


def mixed_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, **options) -> DataFrame:
    """``doc_id`` (a long) and the new columns of ``with_rates``; options are passed to it."""
    out = with_rates(docs, labelled, targets, keep=["doc_id"], **options)
    return out.withColumn("doc_id", F.col("doc_id").cast("long"))
