"""Deleted-interpolation n-gram scoring.

A text is the words ``[^\\x20\\x09-\\x0D]+`` in lower case (A-Z) and one end symbol.
The model of order ``n`` is ::

    P_0(w)     = 1 / (V + 1)
    P_k(w | h) = l_k[b] * c(h, w) / c(h) + (1 - l_k[b]) * P_{k-1}(w | h')

with ``h`` the last ``k - 1`` words (start symbols before the first), ``h'`` the same
without the oldest word, ``b`` the bucket of the context's frequency (powers of two;
an unseen context passes all weight down).  The weights are learned by
expectation-maximisation on a deleted tenth of the learning documents, against the
counts of the other nine tenths; the model then counts all learning documents.

EM needs each held-out token only through its bucket and the ratio of the two
probabilities that are mixed.  Those ratios are counted on a logarithmic grid of
1/64 octave, so that what the driver iterates over is bounded by the grid however
large the corpus is.
"""

from __future__ import annotations

import functools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitpanel.llm import blocks as B
from pitpanel.llm.hashing import LOWER, mix, word_hashes
from pitpanel.session import materialize

U = np.uint64
END, START, STEP = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F), U(0x2545F4914F6CDD1D)
TESTED, KEPT, DELETED = 0, 1, 2         # kinds of blocks
ANSWER_SCHEMA = B.EXCHANGE_SCHEMA + ", types long, tokens long, deleted long"
SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
GRID, ZERO = 64, -(1 << 30)


def tokens(row):
    """Token values of a block, and each document's first token and end."""
    ids, bounds, raw = B.open_block(row)
    words, _, _, firsts = word_hashes(LOWER[raw], bounds)
    n = np.arange(len(ids))
    first, end = firsts[:-1] + n, firsts[1:] + n
    values = np.empty(len(words) + len(ids), dtype=U)
    is_end = np.zeros(len(values), dtype=bool)
    is_end[end] = True
    values[is_end] = END
    values[~is_end] = words
    return values, first, end


def gram_keys(row, order):
    """Distinct n-grams of a block, and for each level the index of every token's
    n-gram; a key's low bits are its level."""
    values, first, _ = tokens(row)
    grams, gram = [], mix(values)
    for k in range(1, order + 1):
        if k > 1:
            context = np.empty_like(gram)
            context[1:] = gram[:-1]
            context[first] = START * U(k)
            gram = mix(context * STEP + values)
        grams.append((gram & ~U(7)) | U(k))
    keys, index = np.unique(np.concatenate(grams), return_inverse=True)
    return keys, index.reshape(order, len(values)), first


def count_rows(row, order, parts):
    keys, index, _ = gram_keys(row, order)
    count = np.bincount(index.ravel(), minlength=len(keys)) if row["kind"] != TESTED else np.zeros(len(keys), dtype=np.int64)
    deleted = count if row["kind"] == DELETED else np.zeros_like(count)
    return B.deal(row["block"], keys, parts, count, deleted)[0]


def total_counts(rows):
    """Corpus counts for every entry, and the part's share of the totals."""
    batches = [B.unpack(r["payload"], r["n"], U, np.int64, np.int64) for r in rows]
    keys, index = np.unique(np.concatenate([b[0] for b in batches]), return_inverse=True)
    total = np.bincount(index, weights=np.concatenate([b[1] for b in batches]), minlength=len(keys)).astype(np.int64)
    deleted = np.bincount(index, weights=np.concatenate([b[2] for b in batches]), minlength=len(keys)).astype(np.int64)
    words = (keys & U(7)) == 1
    out, at = [(rows[0]["part"], -1, 0, b"", int((total[words] > 0).sum()), int(total[words].sum()), int(deleted[words].sum()))], 0
    for r in rows:
        mine = index[at:at + r["n"]]
        at += r["n"]
        out.append((r["part"], r["block"], r["n"], B.pack(total[mine], deleted[mine]), 0, 0, 0))
    return out


def answered(row, answers, order, parts):
    """Index of the n-grams of a block, and their corpus counts (all, deleted)."""
    keys, index, first = gram_keys(row, order)
    at = np.argsort(B.part_of(keys, parts), kind="stable")
    total, deleted = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
    if answers:
        got = [B.unpack(a["payload"], a["n"], np.int64, np.int64) for a in answers]
        total[at], deleted[at] = (np.concatenate(x) for x in zip(*got))
    end = int(np.searchsorted(keys, (mix(np.array([END])) & ~U(7)) | U(1))[0])
    return index, first, total, deleted, end


def bucket_of(count):
    """Frequency bucket of a context: its power of two; -1 for an unseen one."""
    return np.where(count > 0, np.frexp(np.maximum(count, 1).astype(float))[1] - 1, -1)


def levels(index, first, count, end, n_tokens, n_types):
    """For each level: bucket of every token's context, maximum-likelihood estimate."""
    for k in range(len(index)):
        here = count[index[k]]
        if k == 0:
            context = np.full(len(here), n_tokens, dtype=np.int64)
        else:
            context = np.empty(len(here), dtype=np.int64)
            context[1:] = count[index[k - 1]][:-1]
            context[first] = count[end]          # every text starts once and ends once
        bucket = bucket_of(context)
        yield (np.minimum(bucket, 0) if k == 0 else bucket), here / np.maximum(context, 1)


def mixed(weights, stages, n_types):
    """Probability of every token under the levels whose weights are known."""
    p = None
    for weight, (bucket, ml) in zip(weights, stages):
        p = np.full(len(ml), 1 / (n_types + 1)) if p is None else p
        w = np.asarray(weight)[bucket + 1]
        p = w * ml + (1 - w) * p
    return p


def ratio_rows(row, answers, order, parts, n_tokens, n_types, weights):
    """Counts of (bucket, log ratio) of the deleted tokens at the next level."""
    index, first, total, deleted, end = answered(row, answers, order, parts)
    stages = list(levels(index[:len(weights) + 1], first, total - deleted, end, n_tokens, n_types))
    lower = mixed(weights, stages, n_types) if weights else np.full(len(index[0]), 1 / (n_types + 1))
    bucket, ml = stages[-1]
    seen = bucket >= 0
    ratio = ml[seen] / lower[seen]
    grid = np.full(len(ratio), ZERO, dtype=np.int64)
    grid[ratio > 0] = np.round(GRID * np.log2(ratio[ratio > 0])).astype(np.int64)
    pairs, n = np.unique(np.stack([bucket[seen], grid]), axis=1, return_counts=True)
    return list(zip(pairs[0].tolist(), pairs[1].tolist(), n.tolist()))


def learn_weights(histogram: list[tuple[int, int, int]], rounds: int = 200) -> list[float]:
    """Mixture weight of each bucket by EM; entry 0 is for unseen contexts.

    ``histogram`` has (bucket, grid point of log2 ratio, tokens).  One imagined token
    for each side keeps a bucket with little held-out text near a half.
    """
    top = max([b for b, _, _ in histogram], default=0)
    weights = [0.0] + [0.5] * 64
    for b in range(top + 1):
        mine = [(g, n) for bucket, g, n in histogram if bucket == b]
        if not mine:
            continue
        ratio = np.array([0.0 if g == ZERO else 2.0 ** (g / GRID) for g, _ in mine])
        n = np.array([float(n) for _, n in mine])
        w = 0.5
        for _ in range(rounds):
            new = ((n * w * ratio / (w * ratio + 1 - w)).sum() + 1) / (n.sum() + 2)
            if abs(new - w) < 1e-10:
                break
            w = new
        weights[b + 1] = float(new)
    return weights


def score_rows(row, answers, order, parts, n_tokens, n_types, weights):
    index, first, total, _, end = answered(row, answers, order, parts)
    p = mixed(weights, levels(index, first, total, end, n_tokens, n_types), n_types)
    here = total[index[0]]
    base = np.log10((here + 0.5) / (n_tokens + 0.5 * (n_types + 1)))
    sums = [np.add.reduceat(x, first) for x in (np.ones(len(here), dtype=np.int64), (here > 0).astype(np.int64), base, np.log10(p))]
    return list(zip(row["ids"], [row["kind"] == TESTED] * len(first), sums[0].tolist(), sums[1].tolist(), [n_tokens] * len(first),
                    sums[2].tolist(), sums[3].tolist()))


def interpolated_scores(docs: DataFrame, order: int = 2, folds: int = 5, held_out_fold: int = 1,
                        doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score, score`` (log10).

    Documents with crc32(``doc_id``) modulo ``folds`` equal to ``held_out_fold`` are
    scored but not learned from.  ``base_score`` is the add-half unigram.  All counts
    cover the whole learning corpus; no word or n-gram is dropped.

    Null and empty texts are the end symbol alone; a null ``doc_id`` belongs to the
    fold of the empty string; repeated rows count as often as they occur; an empty
    table gives no rows; a table with no learning rows is scored by the uniform
    floor; other columns are ignored.
    """
    crc = F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    kind = F.when(crc % folds == held_out_fold, F.lit(TESTED)).when(F.floor(crc / folds) % 10 == 0, F.lit(DELETED)).otherwise(F.lit(KEPT))
    parts = B.n_parts(B.text_bytes(docs, text))
    blocks = B.make_blocks(docs, kind, doc_id, text, name="lm-blocks")
    entries = B.map_blocks(blocks, functools.partial(count_rows, order=order, parts=parts), B.EXCHANGE_SCHEMA)
    counts = materialize(B.reduce_parts(entries, total_counts, ANSWER_SCHEMA), "lm-counts")
    n = counts.where(F.col("block") < 0).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("types", "tokens", "deleted")]).first()
    answers = counts.where(F.col("block") >= 0).select("part", "block", "n", "payload")
    known = {"order": order, "parts": parts, "n_types": n["types"]}
    weights: list[list[float]] = []
    for _ in range(order):
        rows = functools.partial(ratio_rows, n_tokens=n["tokens"] - n["deleted"], weights=list(weights), **known)
        ratios = B.by_block(blocks.where(F.col("kind") == DELETED), answers.where(F.col("block") % B.KINDS == DELETED), rows, "bucket int, grid long, tokens long")
        weights.append(learn_weights([tuple(r) for r in ratios.groupBy("bucket", "grid").agg(F.sum("tokens").alias("tokens")).collect()]))
    return B.by_block(blocks, answers, functools.partial(score_rows, n_tokens=n["tokens"], weights=weights, **known), SCORE_SCHEMA)


def perplexity(scores: DataFrame, column: str = "score") -> DataFrame:
    """Perplexity over the scored tokens, for held-out and learning documents."""
    return scores.groupBy("held_out").agg((F.pow(F.lit(10.0), -F.sum(column) / F.sum("n_tokens"))).alias("perplexity"))


