"""Quality classifier by positive-unlabelled learning with the non-negative risk.

Training sees trusted positives (P) and unlabelled text (U) only, never a negative.
With the class prior p, the risk of a scorer on U's negatives is what U's risk as
negatives exceeds p times P's risk as negatives:

    R = p * R_P(+) + max(0, R_U(-) - p * R_P(-))

The maximum keeps the second term from going below zero, where an over-fitted
scorer would drive it; while it is below, the step goes against it instead. The
scorer is linear in the features with the logistic loss, fitted by full-batch
Adam steps on the driver over at most ``max_rows`` rows of P and of U, chosen by a
seeded hash: the documented bound of what is collected. Scoring covers all rows
in one scan with no shuffle.

The class prior is estimated from the two samples (``class_prior``): a first
scorer tells P from U; for every threshold that keeps enough of P, the share of U
above it over the share of P above it bounds the prior from above, and the least
bound is taken.

Features look at the whole text and nothing else: frequencies of pairs of byte
classes (square roots), the share of words that repeat the word before them or
the second before, the share of distinct words, mean word length, share of
words in capitals, words per line, and length.

Defined results: null text is empty; an empty text has features of zero and a
score like any other; a null id counts as the empty text in the fold; repeated
rows are scored alike; of the texts of a repeated id the smallest is learnt from; labels for absent documents and null labels are ignored;
without positives or unlabelled rows every score is 0.5 (predicted 1); an empty
table gives an empty result; input columns named score or predicted are replaced
and others kept.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import share, slices, without
from tidemark.llm.ngram_join import hash_words

_CLASS = np.zeros(256, np.int64)
for _i, _bytes in enumerate((b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\t\r",
                             b".", b",", b"!?", b"#$%&*@^~=+<>_\\", b"\"'`", b"()[]{}", b"|/", b"-:;"), 1):
    _CLASS[list(_bytes)] = _i
_CLASS[128:192], _CLASS[192:] = 14, 15
N_FEATURES = 256 + 7


def features(texts: list[bytes]) -> np.ndarray:
    """One row of N_FEATURES a text."""
    parts = [_features(texts[a:b]) for a, b in slices([len(t) for t in texts])]
    return np.concatenate(parts) if parts else np.zeros((0, N_FEATURES), np.float32)


def _features(texts: list[bytes]) -> np.ndarray:
    """All texts together."""
    out = np.zeros((len(texts), N_FEATURES), np.float32)
    words, at, bounds, starts = hash_words(texts)
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    sizes = np.diff(starts) - 1
    kind = _CLASS[data]
    row = np.repeat(np.arange(len(texts)), sizes + 1)
    within = np.ones(len(data), bool)                   # not from or to the byte after a text
    within[starts[1:] - 1] = False
    within = within[:-1] & within[1:]
    pairs = np.bincount((row[:-1] * 256 + kind[:-1] * 16 + kind[1:])[within], minlength=len(texts) * 256)
    out[:, :256] = np.sqrt(pairs.reshape(-1, 256) / np.maximum(sizes, 1)[:, None])
    n = np.diff(bounds)
    owner = np.repeat(np.arange(len(texts)), n)
    safe = np.maximum(n, 1)
    for i, lag in enumerate((1, 2)):
        same = np.zeros(len(words), bool)
        same[lag:] = (words[lag:] == words[:-lag]) & (owner[lag:] == owner[:-lag])
        out[:, 256 + i] = np.bincount(owner[same], minlength=len(texts)) / safe
    order = np.lexsort((words, owner))
    new = np.ones(len(words), bool)
    new[1:] = (words[order][1:] != words[order][:-1]) | (owner[order][1:] != owner[order][:-1])
    out[:, 258] = np.bincount(owner[order][new], minlength=len(texts)) / safe
    ink = np.bincount(row[~np.isin(kind, (4, 5))], minlength=len(texts))
    out[:, 259] = np.log1p(ink / safe)
    capital = (kind[at] == 2) & (kind[np.minimum(at + 1, len(data) - 1)] == 2)
    out[:, 260] = np.bincount(owner[capital], minlength=len(texts)) / safe
    lines = np.bincount(row[data == 10], minlength=len(texts)) + 1
    out[:, 261] = np.log1p(n / lines)
    out[:, 262] = np.log1p(sizes)
    out[sizes == 0] = 0
    return out


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = ((x - self.mean) / self.scale).astype(np.float64) @ self.weight + self.bias
        return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def _adam(gradient, size: int, steps: int, rate: float) -> np.ndarray:
    w, m, v = (np.zeros(size, np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = (w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return w


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def nonnegative_fit(p: np.ndarray, u: np.ndarray, prior: float, steps: int = 300, rate: float = 0.05,
                    ridge: float = 1e-4) -> np.ndarray:
    """Weights (last: bias) of least non-negative risk; ``p``, ``u`` with a column of ones."""
    def gradient(w):
        zp, zu = p @ w, u @ w
        gain_p = -(p.T @ _sigmoid(-zp)) / len(p)           # of the positives' risk as positives
        cost_u = (u.T @ _sigmoid(zu)) / len(u)             # of the unlabelled rows' risk as negatives
        cost_p = (p.T @ _sigmoid(zp)) / len(p)             # of the positives' risk as negatives
        rest = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
        g = prior * gain_p + (cost_u - prior * cost_p) if rest >= 0 else prior * cost_p - cost_u
        return g + ridge * np.append(w[:-1], 0)

    return _adam(gradient, p.shape[1], steps, rate)


def class_prior(p: np.ndarray, u: np.ndarray, steps: int = 200) -> float:
    """The estimated share of positives among the unlabelled rows."""
    half_p, half_u = len(p) // 2, len(u) // 2
    if not half_p or not half_u:
        return 0.5

    def separate(w):                                        # P against U, both sides with equal weight
        return (u[:half_u].T @ _sigmoid(u[:half_u] @ w)) / half_u - (p[:half_p].T @ _sigmoid(-(p[:half_p] @ w))) / half_p \
            + 1e-3 * np.append(w[:-1], 0)

    w = _adam(separate, p.shape[1], steps, 0.05)
    sp, su = np.sort(p[half_p:] @ w), np.sort(u[half_u:] @ w)
    cuts = np.quantile(sp, np.linspace(0, 0.5, 51))
    above_p = 1 - np.searchsorted(sp, cuts) / len(sp)
    above_u = 1 - np.searchsorted(su, cuts) / len(su)
    slack = np.sqrt(above_u * (1 - above_u) / len(su)) + 1 / len(su)     # one standard error
    return float(np.clip(((above_u + slack) / above_p).min(), 0.05, 0.98))


def fold(id_col: str) -> Column:
    """crc32 of the id as text, modulo 3."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % 3


def _sample(ids: DataFrame, most: int, seed: int) -> DataFrame:
    """At most ``most`` distinct ids: those of least seeded hash.

    Only hashes in the lowest part of the range, where twice as many are expected,
    are ordered, so what is ordered does not grow with the table.
    """
    n = ids.count()
    part = min(1.0, (2 * most + 1000) / max(n, 1))
    h = F.xxhash64("tm_id", F.lit(seed))
    low = ids.select("tm_id").filter(h <= min((1 << 63) - 1, int(part * (1 << 64)) - (1 << 63)))
    return low.distinct().orderBy(h, "tm_id").limit(most)


def fit(docs: DataFrame, positives: DataFrame, unlabelled: DataFrame, id_col: str = "doc_id", text_col: str = "text",
        max_rows: int = 10_000, seed: int = 7) -> Model | None:
    """A model from the ids (column ``tm_id``) of trusted positives and of unlabelled rows of ``docs``."""
    chosen = _sample(positives, max_rows, seed).withColumn("tm_side", F.lit(1)).unionByName(
        _sample(unlabelled, max_rows, seed + 1).withColumn("tm_side", F.lit(0)))

    def run(batches):
        for batch in batches:
            x = features([t or b"" for t in batch.column(2).cast(pa.large_binary()).to_pylist()])
            yield pa.RecordBatch.from_pydict({"id": batch.column(0), "side": batch.column(1),
                                              "x": pa.array([r.tobytes() for r in x], pa.binary())})

    # 2 * max_rows ids: small enough to broadcast, and the bound on what is collected.
    kept = (docs.select(F.col(id_col).alias("tm_id"), F.col(text_col).alias("tm_text"))
            .join(F.broadcast(chosen), "tm_id").groupBy("tm_id", "tm_side").agg(F.min("tm_text").alias("tm_text")))
    rows = kept.mapInArrow(run, "id long, side int, x binary").toArrow().sort_by([("side", "ascending"), ("id", "ascending")])
    side = rows["side"].to_numpy()
    x = np.frombuffer(b"".join(rows["x"].to_pylist()), np.float32).reshape(len(side), N_FEATURES)
    if not (side == 1).any() or not (side == 0).any():
        return None
    mean, scale = x[side == 0].mean(axis=0), x[side == 0].std(axis=0) + 1e-2
    z = np.clip(np.column_stack([(x - mean) / scale, np.ones(len(x))]), -10, 10).astype(np.float32)
    order = np.random.default_rng(seed)
    p, u = order.permutation(z[side == 1]), order.permutation(z[side == 0])
    prior = class_prior(p, u)
    w = nonnegative_fit(p, u, prior)
    return Model(mean, scale, w[:-1], float(w[-1]), prior)


def score(docs: DataFrame, model: Model | None, text_col: str = "text") -> DataFrame:
    """``docs`` plus score (0 to 1) and predicted (1 if score >= 0.5, else 0)."""
    docs = without(docs, ["score", "predicted"])
    shared = share(docs.sparkSession, model)

    def run(batches):
        held = shared()
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index(text_col)).cast(pa.large_binary()).to_pylist()
            s = held.scores(features([t or b"" for t in texts])) if held else np.full(len(texts), 0.5)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(s), pa.array((s >= 0.5).astype(np.int32))],
                                             names=[*batch.schema.names, "score", "predicted"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{fields}, score double, predicted int")


def fit_on_labels(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  quality_col: str = "quality", max_rows: int = 10_000) -> Model | None:
    """Positives: rows of quality 1 outside the held-out fold. Unlabelled: all documents outside it."""
    ours = docs.select(F.col(id_col).alias("tm_id")).filter(fold("tm_id") != 1)
    trusted = labels.select(F.col(id_col).alias("tm_id"), quality_col).filter((fold("tm_id") != 1) & (F.col(quality_col) == 1))
    return fit(docs, trusted.join(ours, "tm_id", "left_semi"), ours, id_col, text_col, max_rows)
