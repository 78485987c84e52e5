"""Document quality from a linear-chain conditional random field over lines.

Each line is good or bad. Its features are eight measures cut into levels, its own and those of the lines before and after it;
a weight table per place gives the log odds of bad, and a 2 x 2 table scores neighbouring states. Forward-backward marginals,
weighted by the lines' lengths, give the good share of a document, and a logistic curve maps that to the probability of label 1.

Labels are of documents. Lines of documents labelled 1 are good; lines of others start as bad, and after each round keep
that label only where the model agrees (or everywhere, where it agrees nowhere). Fitting takes whole documents, those with the
smallest md5 of their id, at most SAMPLE of each label and of LINES lines together (one at least); only their lines' levels reach
the driver. Scoring covers every document, in one pass without a shuffle.
"""

from __future__ import annotations

import math
from operator import eq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import materialize

#: labelled documents of each label that fitting takes at most
SAMPLE = 1500
#: lines of each label that fitting takes at most, unless the first document has more
LINES = 250_000
ROUNDS = 3
STEPS = 80
CHAIN = 48
THRESHOLD = 0.3
#: rows and bytes of text that are scored together
ROWS, BYTES = 512, 1 << 22
#: upper limits of each measure's levels
LEVELS = (
    (0.05, 0.15, 0.3, 0.6),  # upper-case ASCII letters, of all bytes
    (0.01, 0.04, 0.1, 0.2, 0.4),  # signs other than common punctuation, of all bytes
    (0.02, 0.1, 0.3, 0.6),  # words equal to the one before
    (0.2, 0.5, 0.75, 0.9),  # different words, of all words
    (2.5, 4.0, 6.0, 9.0, 14.0),  # mean bytes of a word
    (0.01, 0.05, 0.2, 0.5),  # digits, of all bytes
    (1.5, 4.5, 10.5, 30.5, 100.5),  # words
    (0.02, 0.1, 0.3, 0.7),  # words that end in an unusual sign
)
WIDTH = max(map(len, LEVELS)) + 2  # one more level: no such line
PLACES = 3
_UPPER, _DIGITS, _SIGNS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b"!#$%&*+/<=>@[\\]^_`{|}~"
_EDGES = [np.array(x) for x in LEVELS]
_BEFORE_SPACE = [s + b" " for s in (b"!", b"#", b"$", b"%", b"&", b"*", b"|", b"~", b"=", b"@")]


def measures(line: bytes) -> tuple[float, ...]:
    n, words = len(line), line.split()
    if not words:
        return (0.0,) * len(LEVELS)
    w = len(words)
    ends = sum(map(line.count, _BEFORE_SPACE)) + (line[-1:] in _SIGNS)
    return (
        (n - len(line.translate(None, _UPPER))) / n,
        (n - len(line.translate(None, _SIGNS))) / n,
        sum(map(eq, words, words[1:])) / w,
        len(set(words)) / w,
        (n - w + 1) / w,
        (n - len(line.translate(None, _DIGITS))) / n,
        float(w),
        ends / w,
    )


def levels(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines x measures levels, line lengths, lines of each text); an empty text is one empty line."""
    rows, lengths, counts = [], [], []
    for text in texts:
        lines = text.split(b"\n")
        counts.append(len(lines))
        for line in lines:
            rows.append(measures(line))
            lengths.append(len(line) + 1)
    values = np.array(rows, dtype=np.float64).reshape(len(rows), len(LEVELS))
    out = np.stack([np.searchsorted(e, values[:, k], side="left") for k, e in enumerate(_EDGES)], axis=1)
    return out, np.array(lengths, dtype=np.float64), np.array(counts)


def _places(lev: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indexes into the flat weight table: own, previous and next line's levels."""
    none = np.full((1, lev.shape[1]), WIDTH - 1)
    before, after = np.vstack([none, lev[:-1]]), np.vstack([lev[1:], none])
    ends = np.cumsum(counts)
    before[ends - counts], after[ends - 1] = WIDTH - 1, WIDTH - 1
    k = np.arange(lev.shape[1]) * WIDTH
    size = lev.shape[1] * WIDTH
    return np.hstack([lev + k, before + k + size, after + k + 2 * size])


def _marginals(odds: np.ndarray, trans: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(bad) of each line, and the expected counts of neighbouring states, all chains stepping together."""
    order = np.argsort(-counts, kind="stable")
    starts, length = (np.cumsum(counts) - counts)[order], counts[order]
    emit = np.stack([np.zeros_like(odds), odds], axis=1)
    alpha, beta = emit.copy(), np.zeros_like(emit)
    active = [int(np.searchsorted(-length, -t, side="left")) for t in range(int(length[0]))] if len(length) else []
    for t in range(1, len(active)):
        at = starts[: active[t]] + t
        prev = alpha[at - 1]
        alpha[at] += np.logaddexp(prev[:, :1] + trans[0], prev[:, 1:] + trans[1])
    pairs = np.zeros((2, 2))
    for t in range(len(active) - 1, 0, -1):
        at = starts[: active[t]] + t
        nxt = beta[at] + emit[at]
        beta[at - 1] = np.logaddexp(trans[:, 0] + nxt[:, :1], trans[:, 1] + nxt[:, 1:])
        joint = alpha[at - 1][:, :, None] + trans[None] + nxt[:, None, :]
        joint = np.exp(joint - joint.max(axis=(1, 2), keepdims=True))
        pairs += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
    both = alpha + beta
    return 1 / (1 + np.exp(np.clip(both[:, 0] - both[:, 1], -500, 500))), pairs


def _good_share(bad: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
    starts = np.cumsum(counts) - counts
    return np.add.reduceat((1 - bad) * lengths, starts) / np.add.reduceat(lengths, starts)


class LineCrf:
    """Weights, transitions and the curve from good share to score."""

    def __init__(self, weights: np.ndarray, bias: float, trans: np.ndarray, slope: float, shift: float):
        self.weights, self.bias, self.trans, self.slope, self.shift = weights, bias, trans, slope, shift

    def good_shares(self, lev: np.ndarray, lengths: np.ndarray, counts: np.ndarray) -> np.ndarray:
        bad, _ = _marginals(self.weights[_places(lev, counts)].sum(axis=1) + self.bias, self.trans, counts)
        return _good_share(bad, lengths, counts)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        return _curve(self.good_shares(*levels(texts)), self.slope, self.shift)


def _logit(share: np.ndarray) -> np.ndarray:
    share = np.clip(share, 0.001, 0.999)
    return np.log(share / (1 - share))


def _curve(share: np.ndarray, slope: float, shift: float) -> np.ndarray:
    return 1 / (1 + np.exp(-(slope * _logit(share) + shift)))


def fit(lev: np.ndarray, lengths: np.ndarray, counts: np.ndarray, good: np.ndarray, totals: tuple[float, float]) -> LineCrf:
    """A model from the levels() of whole labelled texts; totals: labelled documents of label 0 and 1 that the sample stands for."""
    size = PLACES * len(LEVELS) * WIDTH
    weights, bias, trans = np.zeros(size), 0.0, np.zeros((2, 2))
    rate = (totals[1] + 1) / (sum(totals) + 2)
    if not len(counts) or good.all() or not good.any():
        return LineCrf(weights, bias, trans, 0.0, math.log(rate / (1 - rate)))
    places, doc = _places(lev, counts), np.repeat(np.arange(len(counts)), counts)
    y = (~good)[doc].astype(float)
    # while fitting, chains are cut every CHAIN lines, so that one long document does not set the number of steps
    chains = np.concatenate([np.append(np.full(n // CHAIN, CHAIN), [n % CHAIN] if n % CHAIN else []) for n in counts]).astype(np.int64)
    inner = np.ones(len(y), bool)
    inner[np.cumsum(chains) - chains] = False
    theta, m, v, step = np.zeros(size + 5), np.zeros(size + 5), np.zeros(size + 5), 0
    each = 1.0 / counts[doc]  # long documents do not outweigh short ones
    for _ in range(ROUNDS):
        for _ in range(STEPS):
            w, b, tr = theta[:size], theta[size], theta[size + 1 :].reshape(2, 2)
            bad, pairs = _marginals(w[places].sum(axis=1) + b, tr, chains)
            err = (y - bad) * each
            now, was = y[inner], y[np.nonzero(inner)[0] - 1]
            seen = np.array([[((1 - was) * (1 - now)).sum(), ((1 - was) * now).sum()], [(was * (1 - now)).sum(), (was * now).sum()]])
            grad = np.concatenate([np.bincount(places.ravel(), np.repeat(err, places.shape[1]), size), [err.sum()], ((seen - pairs) / max(1.0, counts.mean())).ravel()])
            grad -= 0.5 * theta
            step += 1
            m, v = 0.9 * m + 0.1 * grad, 0.99 * v + 0.01 * grad * grad
            theta = theta + 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        agrees = (bad > 0.5) & ~good[doc]
        some = np.bincount(doc, agrees, len(counts)) > 0
        y = np.where(some[doc], agrees, ~good[doc]).astype(float)
    model = LineCrf(theta[:size], float(theta[size]), theta[size + 1 :].reshape(2, 2).copy(), 1.0, 0.0)
    x = _logit(model.good_shares(lev, lengths, counts))
    weight = np.where(good, totals[1] / good.sum(), totals[0] / (~good).sum())
    slope, shift = 1.0, 0.0
    for _ in range(50):  # Newton steps of the weighted logistic fit, the slope held positive
        p = 1 / (1 + np.exp(-np.clip(slope * x + shift, -500, 500)))
        err, h = weight * (good - p), weight * p * (1 - p)
        g = np.array([(err * x).sum() - 0.1 * (slope - 1), err.sum()])
        hess = np.array([[(h * x * x).sum() + 0.1, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        move = np.linalg.solve(hess, g)
        slope, shift = max(0.05, slope + float(np.clip(move[0], -1, 1))), shift + float(np.clip(move[1], -1, 1))
    model.slope, model.shift = slope, shift
    return model


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> LineCrf:
    """Fit on documents that are labelled and not held out. Null ids and labels are left out; a document labelled both ways counts as 0.
    Of texts that share an id, the one with the smallest xxhash64 counts."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
    known = known.groupBy(id_col).agg(F.min(label_col).alias("_good"))
    known = known.join(docs.select(id_col), id_col, "left_semi")
    totals = {bool(r[0]): r[1] for r in known.groupBy(F.col("_good") > 0).count().collect()}
    picked = None
    for side in (F.col("_good") > 0, F.col("_good") <= 0):
        part = known.where(side).orderBy(F.md5(F.col(id_col).cast("string")), id_col).limit(sample)
        picked = part if picked is None else picked.unionByName(part)
    # at most 2 * sample ids, so this side may be broadcast
    text = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("_t"))
    text = text.join(F.broadcast(picked), id_col).groupBy(id_col, "_good").agg(F.min(F.struct(F.xxhash64("_t").alias("h"), F.col("_t").alias("t")))["t"].alias("_t"))

    def run(batches):
        for batch in batches:
            for i, t in enumerate(batch.column(2).to_pylist()):
                lev, lengths, _ = levels([t])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, 1), batch.column(1).slice(i, 1), pa.array([len(lev)], pa.int64()), pa.array([lev.astype(np.uint8).tobytes()], pa.binary()), pa.array([lengths.tobytes()], pa.binary())], names=["o", "good", "n", "lev", "lengths"])

    label = "good " + picked.schema["_good"].dataType.simpleString()
    rows = materialize(text.select(F.md5(F.col(id_col).cast("string")), "_good", "_t").mapInArrow(run, f"o string, {label}, n long, lev binary, lengths binary"), "quality-levels")
    by = Window.partitionBy(F.col("good") > 0).orderBy("o")  # of at most 2 * sample rows
    few = rows.withColumn("before", F.coalesce(F.sum("n").over(by.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))).where((F.col("before") <= LINES) | (F.col("before") == F.col("n")))
    few = few.orderBy("o").drop("o", "before").collect()
    good = np.array([r[0] > 0 for r in few], bool)
    lev = np.concatenate([np.frombuffer(r[2], np.uint8).reshape(-1, len(LEVELS)) for r in few]).astype(np.int64) if few else np.empty((0, len(LEVELS)), np.int64)
    lengths = np.concatenate([np.frombuffer(r[3], np.float64) for r in few]) if few else np.empty(0)
    return fit(lev, lengths, np.array([r[1] for r in few], np.int64), good, (float(totals.get(False, 0)), float(totals.get(True, 0))))


def rounds(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Spans of rows that are scored together: up to ROWS of them, with up to BYTES of text or one row, since the work on a line takes
    many times its length."""
    out, start, total = [], 0, 0.0
    for i, n in enumerate(sizes):
        if i > start and (total + n > BYTES or i - start >= ROWS):
            out.append((start, i))
            start, total = i, 0.0
        total += n
    return [*out, (start, len(sizes))] if len(sizes) else out


def score(docs: DataFrame, model: LineCrf, text_col: str = "text", out: str = "score") -> DataFrame:
    """docs with `out`: the probability of label 1. A null text is scored as an empty one; every column passes through."""
    fields = [f for f in docs.schema.fields if f.name != out]
    from pyspark.sql.types import DoubleType, StructType

    schema = StructType([*fields, *StructType().add(out, DoubleType()).fields])
    at = [f.name for f in fields].index(text_col)

    def run(batches):
        for batch in batches:
            sizes = np.nan_to_num(pc.binary_length(batch.column(at).cast(pa.binary())).to_numpy(zero_copy_only=False).astype(np.float64))
            for start, end in rounds(sizes):
                part = batch.slice(start, end - start)
                texts = [t or b"" for t in part.column(at).cast(pa.binary()).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(model.scores(texts), pa.float64())], names=[*part.schema.names, out])

    return docs.select(*[f"`{f.name}`" for f in fields]).mapInArrow(run, schema)


def op9_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score(docs, model)
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
