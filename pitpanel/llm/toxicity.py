"""Toxicity by class-conditional Kneser-Ney models.

Two character models, one learned from toxic and one from ordinary documents, give
every word a log-likelihood; a word's evidence is their difference.  Each order
interpolates with the next lower one by absolute discounting; below the highest order
a letter is counted once for each different word it follows its context in (the
continuation counts), and the lowest order is counted over both classes together, so
an expression that neither class holds is judged by the shared letters.  A document's
evidence is the largest length-normalised difference over its passages of ``passage``
words (all of a shorter text), and a logistic curve, fitted on documents that the
counts don't hold, turns it into a score.

The model is fitted on a bounded sample of the labelled rows: ``per_class`` documents
of each class, those with the least hash of their id.  It is broadcast; its size depends
on that parameter, not on the corpus.  Every document is scored whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm.hashing import BYTE_VALUES, LOWER, NOT_LETTERS, Lookup, Sequence, mix, word_hashes

U = np.uint64
ORDER, DISCOUNT = 6, 0.75
OPEN, CLOSE = 2, 3              # bytes that no word holds
GROUP_BYTES = 1 << 20


def framed(words: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between their boundary marks, end to end; the positions of all letters
    to predict, and how many positions precede each in its word."""
    sizes = np.array([len(w) + 2 for w in words], dtype=np.int64)
    data = np.frombuffer(b"".join(b"\x02%b\x03" % w for w in words), dtype=np.uint8)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    depth = np.arange(len(data)) - first
    at = np.flatnonzero(depth > 0)
    return data, at, depth[at]


def keys_of(seq: Sequence, at: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the ``order``-gram that ends at each position, and of its context."""
    start = at - order + 1
    gram = mix(seq.windows(start, order) + U(2 * order))
    context = mix(seq.windows(start, order - 1) + U(2 * order + 1))
    return gram, context


class Model:
    """Log-likelihood ratios (toxic over ordinary) of n-grams and of backing off."""

    def __init__(self, words: list[bytes], ordinary: np.ndarray, toxic: np.ndarray, order: int = ORDER, discount: float = DISCOUNT):
        self.order = order
        data, at, depth = framed(words)
        seq = Sequence(BYTE_VALUES[data])
        word = np.repeat(np.arange(len(words)), [len(w) + 1 for w in words])
        tokens = [np.asarray(c, dtype=float) for c in (ordinary, toxic)]
        grams, ratios, contexts, backoffs = [], [], [], []
        below = None                    # index of the lower gram of each position, and its probabilities
        for n in range(1, order + 1):
            here = np.flatnonzero(depth >= n - 1)
            gram, context = keys_of(seq, at[here], n)
            key, first, index = np.unique(gram, return_index=True, return_inverse=True)
            ckey, cfirst, cindex = np.unique(context, return_index=True, return_inverse=True)
            probabilities, passing = [], []
            # a context that starts the word can't be extended, so it is counted in tokens like the highest order
            whole = (depth[here] == n - 1) | (n == order)
            for c in (0, 1):
                weight = np.where(whole, tokens[c][word[here]], tokens[c][word[here]] > 0)
                if n == 1:
                    weight = np.where(whole, tokens[0][word[here]] + tokens[1][word[here]], 1.0)
                count = np.bincount(index, weights=weight, minlength=len(key))
                total = np.bincount(cindex, weights=weight, minlength=len(ckey))
                of = cindex[first]
                kinds = np.bincount(of, weights=np.minimum(count, discount), minlength=len(ckey))
                left = np.where(total > 0, kinds / np.maximum(total, 1), 1.0)
                lower = np.full(len(key), 1 / 256) if n == 1 else below[1][c][below[0][here[first]]]
                probabilities.append(np.maximum(count - discount, 0) / np.maximum(total[of], 1) + left[of] * lower)
                passing.append(left)
            grams.append(key)
            ratios.append(np.log(probabilities[1] / probabilities[0]))
            contexts.append(ckey)
            backoffs.append(np.log(passing[1] / passing[0]))
            spread = np.zeros(len(at), dtype=np.int64)
            spread[here] = index
            below = (spread, probabilities)
        self.keys = np.concatenate(grams + contexts)
        self.values = np.concatenate(ratios + backoffs).astype(np.float32)
        self.lookup = None

    def __getstate__(self):
        return self.__dict__ | {"lookup": None}

    def evidence(self, words: list[bytes]) -> np.ndarray:
        """Log-likelihood ratio of each word."""
        if not words:
            return np.zeros(0)
        self.lookup = self.lookup or Lookup(self.keys, self.values)
        data, at, depth = framed(words)
        seq = Sequence(BYTE_VALUES[data])
        out = np.zeros(len(at))
        # the longest gram that is known decides; contexts above it that are known pass their weight down
        waiting = np.arange(len(at))
        skipped = np.zeros(len(at), dtype=bool)
        for n in range(self.order, 0, -1):
            deep = depth[waiting] >= n - 1
            mine = waiting[deep]
            gram, context = keys_of(seq, at[mine], n)
            value, known = self.lookup.get(gram)
            out[mine[known]] += value[known]
            lost = mine[~known]
            out[lost] += self.lookup.get(context[~known])[0]
            skipped[:] = False
            skipped[mine[known]] = True
            waiting = waiting[~skipped[waiting]]
        return np.add.reduceat(out, np.cumsum([0] + [len(w) + 1 for w in words[:-1]]))


def passages(evidence: np.ndarray, firsts: np.ndarray, width: int) -> np.ndarray:
    """Largest mean over ``width`` neighbouring words of each document (over all words
    of a shorter one; 0 without words)."""
    sums = np.zeros(len(evidence) + 1)
    np.cumsum(evidence, out=sums[1:])
    n = np.diff(firsts)
    out = np.zeros(len(n))
    short = (n > 0) & (n <= width)
    out[short] = (sums[firsts[1:][short]] - sums[firsts[:-1][short]]) / n[short]
    for i in np.flatnonzero(n > width):
        lo, hi = firsts[i], firsts[i + 1]
        out[i] = (sums[lo + width:hi + 1] - sums[lo:hi + 1 - width]).max() / width
    return out


def unique_words(texts: list[bytes]):
    """Distinct words of texts, the index of each word's, and each text's first word."""
    bounds = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in texts], out=bounds[1:])
    data = LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)]
    keys, start, end, firsts = word_hashes(data, bounds, NOT_LETTERS)
    _, first, index = np.unique(keys, return_index=True, return_inverse=True)
    raw = data.tobytes()
    return [raw[s:e] for s, e in zip(start[first].tolist(), end[first].tolist())], index, firsts


def document_evidence(texts: list[bytes], model: Model, width: int) -> np.ndarray:
    """Evidence of each text, worked off in groups of about ``GROUP_BYTES``."""
    out, group, size = [], [], 0
    for t in [*texts, None]:
        if group and (t is None or size + len(t) > GROUP_BYTES):
            words, index, firsts = unique_words(group)
            out.append(passages(model.evidence(words)[index], firsts, width))
            group, size = [], 0
        if t is not None:
            group.append(t)
            size += len(t)
    return np.concatenate(out) if out else np.zeros(0)


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of a weighted logistic curve, by Newton's method."""
    mean, scale = (x.mean(), x.std() or 1.0) if len(x) else (0.0, 1.0)
    z = np.stack([(x - mean) / scale, np.ones(len(x))], axis=1)
    beta = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        gradient = z.T @ (weight * (y - p)) - ridge * beta
        hessian = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta += step
        if abs(step).max() < 1e-8:
            break
    return float(beta[0] / scale), float(beta[1] - beta[0] * mean / scale)


def fit(docs: DataFrame, labels: DataFrame, per_class: int, passage: int, folds: int, held_out_fold: int):
    """The model, and the slope and intercept of its curve; None without both classes."""
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    learn = marked.where(crc % folds != held_out_fold)
    sizes = {r["toxic"]: r["n"] for r in learn.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return None
    spark = docs.sparkSession
    chosen = [(r["doc_id"], c) for c in (0, 1) for r in learn.where(F.col("toxic") == c).select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class).collect()]
    ids = F.broadcast(spark.createDataFrame(chosen, "doc_id long, toxic int").groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    sample = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id").select("doc_id", "text", "toxic", (F.floor(crc / folds) % 4 == 0).alias("later"))

    def words(batches):
        """Word counts of the fitted texts by class."""
        for batch in batches:
            text, toxic = batch.column(0).to_pylist(), np.array(batch.column(1))
            distinct, index, firsts = unique_words([t or b"" for t in text])
            cls = np.repeat(toxic, np.diff(firsts))
            counts = [np.bincount(index[cls == c], minlength=len(distinct)) for c in (0, 1)]
            yield pa.RecordBatch.from_arrays([pa.array(distinct, pa.binary()), *map(pa.array, counts)], names=["word", "ordinary", "toxic"])

    body = F.col("text").cast("binary").alias("text")
    counted = (sample.where("not later").select(body, "toxic").mapInArrow(words, "word binary, ordinary long, toxic long")
               .groupBy("word").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic")).toArrow())
    if not counted.num_rows:
        return None
    order = np.argsort(np.array([bytes(w) for w in counted["word"].to_pylist()], dtype=object))
    vocabulary = counted["word"].to_pylist()
    model = Model([vocabulary[i] for i in order], counted["ordinary"].to_numpy()[order], counted["toxic"].to_numpy()[order])
    shared = spark.sparkContext.broadcast(model)

    def later(batches):
        for batch in batches:
            x = document_evidence([t or b"" for t in batch.column(0).to_pylist()], shared.value, passage)
            yield pa.RecordBatch.from_arrays([pa.array(x), batch.column(1)], names=["x", "toxic"])

    held = sample.where("later").select(body, "toxic").mapInArrow(later, "x double, toxic int").toArrow()
    x, y = held["x"].to_numpy(), held["toxic"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return shared, 1.0, 0.0
    # as many documents of each class as the labels have
    weight = np.where(y == 1, sizes[1] / y.sum(), sizes[0] / (1 - y).sum())
    return shared, *logistic(x, y, weight * len(y) / weight.sum())


def toxicity_scores(docs: DataFrame, labels: DataFrame, per_class: int = 2000, passage: int = 4,
                    folds: int = 5, held_out_fold: int = 0) -> DataFrame:
    """One row per input row: ``doc_id, held_out, score, predicted, evidence``.

    ``labels`` has ``doc_id, toxic`` (rows with a null or another value are not used).
    Rows whose crc32(``doc_id``) modulo ``folds`` is ``held_out_fold`` are never learned
    from.  Only the text enters the score.

    Null, empty and wordless texts have evidence 0 and the score the curve gives it.
    Where the labels lack one class, every score is 0.  A null ``doc_id`` is scored and
    belongs to the fold of the empty string; repeated rows get equal scores; an empty
    table gives no rows; other columns are ignored.
    """
    crc = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (crc % folds == held_out_fold).alias("held_out"), "text")
    fitted = fit(docs, labels, per_class, passage, folds, held_out_fold)
    if fitted is None:
        return rows.select("doc_id", "held_out", F.lit(0.0).alias("score"), F.lit(0).alias("predicted"), F.lit(0.0).alias("evidence"))
    shared, slope, intercept = fitted

    def score(batches):
        for batch in batches:
            x = document_evidence([t or b"" for t in batch.column(2).to_pylist()], shared.value, passage)
            p = 1 / (1 + np.exp(-np.clip(slope * x + intercept, -700, 700)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(p), pa.array((p >= 0.5).astype(np.int32)), pa.array(x)],
                                             names=["doc_id", "held_out", "score", "predicted", "evidence"])

    return rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(score, "doc_id long, held_out boolean, score double, predicted int, evidence double")


def drop_toxic(docs: DataFrame, labels: DataFrame, per_class: int = 2000, passage: int = 4, folds: int = 5, held_out_fold: int = 0) -> DataFrame:
    """The rows of ``docs``, all columns, whose score is below a half."""
    fitted = fit(docs, labels, per_class, passage, folds, held_out_fold)
    if fitted is None:
        return docs
    shared, slope, intercept = fitted

    def keep(batches):
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            yield batch.filter(pa.array(slope * document_evidence(texts, shared.value, passage) + intercept < 0))

    return docs.mapInArrow(keep, docs.schema)
