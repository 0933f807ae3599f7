"""Quality classifier: a linear-chain CRF over the lines of a document.

Every line (split at ``\\n``) gets a label, good or bad. The unary score of a
line is linear in its own features and those of the line before and after
(character classes, word lengths, adjacent equal words, equal neighbouring
lines); a 2x2 table scores the labels of neighbouring lines. Forward-backward
gives each line's marginal of being good; a document's score is the mean of
the marginals, weighted by line length.

Training: labels are known per document, so each line of a labelled document
carries its label. The model is fitted on the driver by gradient descent on a
bounded sample of labelled rows: the ``sample_rows`` labelled documents with
the smallest hash of their id, at most ``sample_lines`` consecutive lines of
each (a block whose place the text's hash fixes). Only feature arrays are
collected. Scoring takes whole texts, on the executors.

Defined results: null text counts as empty; a text without words scores the
share of label 1 in the sample.
Labels that are null, neither 0 nor 1, or contradict each other for one
document are ignored. If the sample lacks one of the labels, every score is
the share of label 1 in it (without any label: 0.5). Rows with a null id are
scored and never trained on. Empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 4000
SAMPLE_LINES = 100  # with SAMPLE_ROWS: at most 400,000 lines, 80 MB collected and twice 160 MB while fitting
SPLIT_SEED = 17
STEPS = 250
RATE = 0.1
RIDGE = 1e-3
GROUP_BYTES = 1 << 18

# line features from byte classes: name, bytes
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "lower": b"abcdefghijklmnopqrstuvwxyz",
    "digit": b"0123456789",
    "stop": b".,;:?'\"-()",
    "shout": b"!",
    "bar": b"|[]{}\\_<>",
    "symbol": b"$%&*#@^~=+/`",
}
N_OWN = len(_CLASSES) + 9


def _class_tables() -> list[np.ndarray]:
    tables = []
    for members in _CLASSES.values():
        t = np.zeros(256, dtype=np.int32)
        t[list(members)] = 1
        tables.append(t)
    return tables


_TABLES = _class_tables()
_HEAD = np.ones(256, dtype=np.int32)  # 1 for the first byte of a character
_HEAD[0x80:0xC0] = 0
_BLANK = np.zeros(256, dtype=bool)
_BLANK[list(b" \t\r\x0b\x0c\n")] = True
_POWERS = np.cumprod(np.full(1024, 0x9E3779B97F4A7C15, dtype=np.uint64))


def _sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts) if len(starts) else np.zeros(0, values.dtype)


def line_features(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of all lines of the texts, line weights, lines per text."""
    data = np.frombuffer(b"".join(t + b"\n" for t in texts), dtype=np.uint8)
    ends = np.flatnonzero(data == 10)
    starts = np.concatenate(([0], ends[:-1] + 1))
    per_text = np.array([t.count(b"\n") + 1 for t in texts])
    # every line holds its final \n, so no segment is empty
    chars = _sums(_HEAD[data], starts).astype(np.float64) - 1
    counts = [_sums(t[data], starts) for t in _TABLES]

    blank = _BLANK[data]
    before = np.concatenate(([True], blank[:-1]))
    word_at = np.flatnonzero(~blank & before)
    line_of = np.searchsorted(starts, word_at, side="right") - 1
    n_words = np.bincount(line_of, minlength=len(starts)).astype(np.float64)
    # a hash per word, to see equal neighbours
    place = np.arange(len(data)) - word_at[np.maximum(np.cumsum(~blank & before) - 1, 0)] if len(word_at) else None
    if place is not None:
        hashed = np.where(blank, 0, data.astype(np.uint64) * _POWERS[place & 1023])
        words = _sums(hashed, word_at)
        same = np.concatenate(([False], (words[1:] == words[:-1]) & (line_of[1:] == line_of[:-1])))
        repeats = np.bincount(line_of[same], minlength=len(starts)).astype(np.float64)
        rank = np.arange(len(words)) - np.searchsorted(line_of, line_of)
        line_hash = np.zeros(len(starts), dtype=np.uint64)
        np.add.at(line_hash, line_of, words * (2 * rank.astype(np.uint64) + np.uint64(1)))  # depends on word order
    else:
        repeats, line_hash = np.zeros(len(starts)), np.zeros(len(starts), dtype=np.uint64)

    size = np.maximum(chars, 1)
    last = data[np.maximum(ends - 1, 0)]
    first_line = np.zeros(len(starts), dtype=bool)
    first_line[np.concatenate(([0], np.cumsum(per_text)[:-1]))] = True
    like_before = (line_hash == np.roll(line_hash, 1)) & ~first_line & (n_words > 0)
    own = [np.minimum(c / size, 1) * 4 for c in counts]
    own += [
        np.log1p(chars) / 4,
        np.log1p(n_words) / 3,
        chars / np.maximum(n_words, 1) / 8,
        np.minimum(counts[list(_CLASSES).index("shout")] / np.maximum(n_words, 1), 2),
        np.minimum(counts[list(_CLASSES).index("symbol")] / np.maximum(n_words, 1), 4) / 2,
        repeats / np.maximum(n_words, 1) * 3,
        like_before.astype(np.float64),
        np.isin(last, list(b".!?")).astype(np.float64),
        (n_words == 0).astype(np.float64),
    ]
    own = np.minimum(np.stack(own, axis=1), 8)
    # the features of the neighbouring lines of the same text
    above = np.roll(own, 1, axis=0)
    above[first_line] = 0
    below = np.roll(own, -1, axis=0)
    below[np.roll(first_line, -1)] = 0
    return np.hstack([own, above, below, np.ones((len(own), 1))]), chars + 1, per_text


# ---------------------------------------------------------------------- CRF


def _steps(lengths: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Chains by falling length, and how many have a line at each step."""
    order = np.argsort(-lengths, kind="stable")
    alive = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), side="left")
    return order, alive.tolist()


def forward_backward(unary: np.ndarray, change: np.ndarray, lengths: np.ndarray):
    """Per line the marginal of label 1, per chain the log partition, and the
    expected transition counts. ``unary`` is the score of label 1 over 0."""
    order, alive = _steps(lengths)
    first = (np.cumsum(lengths) - lengths)[order]
    scores = np.stack([np.zeros_like(unary), unary], axis=1)
    alpha, beta = np.empty_like(scores), np.zeros_like(scores)
    for t, n in enumerate(alive):
        at = first[:n] + t
        if t:
            came = alpha[at - 1][:, :, None] + change
            alpha[at] = scores[at] + np.logaddexp(came[:, 0], came[:, 1])
        else:
            alpha[at] = scores[at]
    for t in range(len(alive) - 1, 0, -1):
        at = first[: alive[t]] + t
        goes = change + (scores[at] + beta[at])[:, None, :]
        beta[at - 1] = np.logaddexp(goes[:, :, 0], goes[:, :, 1])
    last = np.cumsum(lengths) - 1
    total = np.logaddexp(alpha[last, 0], alpha[last, 1])
    whole = np.repeat(total, lengths)
    marginal = np.exp(np.minimum(alpha[:, 1] + beta[:, 1] - whole, 0))
    inner = np.ones(len(unary), dtype=bool)
    inner[np.cumsum(lengths) - lengths] = False  # lines with a line before them
    at = np.flatnonzero(inner)
    pair = alpha[at - 1][:, :, None] + change + (scores[at] + beta[at])[:, None, :] - whole[at][:, None, None]
    return marginal, total, np.exp(np.minimum(pair, 0)).sum(axis=0)


@dataclass(frozen=True)
class LineCrf:
    """Weights of the line features, label changes; or a constant score."""

    weights: np.ndarray | None
    change: np.ndarray | None
    mean: np.ndarray | None = None
    scale: np.ndarray | None = None
    constant: float = 0.5

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.constant)
        features, weight, lengths = line_features(texts)
        unary = ((features - self.mean) / self.scale) @ self.weights
        blank = features[:, N_OWN - 1] > 0
        unary[blank] = 0  # a line without words says nothing, it only passes labels on
        good, _, _ = forward_backward(unary, self.change, lengths)
        starts = np.cumsum(lengths) - lengths
        weight = np.where(blank, 0, weight)
        total = np.add.reduceat(weight, starts)
        return np.where(total > 0, np.add.reduceat(good * weight, starts) / np.maximum(total, 1), self.constant)


def fit(features: list[np.ndarray], labels: list[int], steps: int = STEPS) -> LineCrf:
    """Maximum likelihood (with a small ridge) by Adam on the whole sample."""
    share = float(np.mean(labels)) if labels else 0.5
    if share in (0.0, 1.0) or not labels:
        return LineCrf(None, None, constant=share)
    lengths = np.array([len(f) for f in features])
    x = np.concatenate(features).astype(np.float64)
    y = np.repeat(np.array(labels, dtype=np.float64), lengths)
    mean, scale = x.mean(axis=0), x.std(axis=0)
    mean[-1], scale = 0.0, np.where(scale > 1e-6, scale, 1.0)  # the last one is the constant
    x -= mean
    x /= scale
    inner = np.ones(len(y), dtype=bool)
    inner[np.cumsum(lengths) - lengths] = False
    seen = np.zeros((2, 2))
    for a in (0, 1):
        seen[a, a] = (y[inner] == a).sum()  # the lines of a document share its label
    theta = np.zeros(x.shape[1] + 4)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        good, _, pairs = forward_backward(x @ theta[:-4], theta[-4:].reshape(2, 2), lengths)
        gradient = np.concatenate([(good - y) @ x, (pairs - seen).ravel()]) / len(lengths) + RIDGE * theta
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient**2
        theta = theta - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return LineCrf(theta[:-4], theta[-4:].reshape(2, 2), mean, scale, share)


# -------------------------------------------------------------------- Spark


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from: crc32 of the id modulo 3 is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sampled_labels(labels: DataFrame, id_col: str, label_col: str, sample_rows: int) -> DataFrame:
    known = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).where(~held_out(F.col(id_col)))
    sure = known.groupBy(F.col(id_col).alias("_id")).agg(F.min(label_col).alias("_label"), F.max(label_col).alias("_most"))
    sure = sure.where("_label = _most").select("_id", "_label")
    return sure.orderBy(F.xxhash64(F.lit(SPLIT_SEED), "_id"), "_id").limit(sample_rows)


def train(
    docs: DataFrame,
    labels: DataFrame,
    sample_rows: int = SAMPLE_ROWS,
    sample_lines: int = SAMPLE_LINES,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> LineCrf:
    """The model, from labelled rows that are not held out."""

    @F.pandas_udf("binary")
    def features(texts: pd.Series) -> pd.Series:
        out = []
        for t in texts:
            lines = t.split(b"\n")
            start = hash_of(t) % max(1, len(lines) - sample_lines + 1)
            x, _, _ = line_features([b"\n".join(lines[start : start + sample_lines])])
            out.append(x.astype(np.float32).tobytes())
        return pd.Series(out, dtype=object)

    def hash_of(t: bytes) -> int:
        from xxhash import xxh64_intdigest

        return xxh64_intdigest(t)

    # at most sample_rows ids: a bounded broadcast
    wanted = F.broadcast(_sampled_labels(labels, id_col, label_col, sample_rows))
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    rows = docs.select(F.col(id_col).alias("_id"), text.alias("_text")).join(wanted, "_id")
    # an id may stand in several rows: the bound holds for rows too
    rows = rows.withColumn("_hash", F.xxhash64("_text")).orderBy(F.xxhash64(F.lit(SPLIT_SEED), "_id"), "_id", "_hash").limit(sample_rows)
    sample = rows.select("_label", features("_text").alias("x")).collect()
    return fit([np.frombuffer(r["x"], np.float32).reshape(-1, 3 * N_OWN + 1) for r in sample], [r["_label"] for r in sample])


def score_column(model: LineCrf, text: Column) -> Column:
    """The score of whole texts, on the executors."""

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            out, group, held = [], [], 0
            for t in texts:
                if group and held + len(t) > GROUP_BYTES:
                    out.append(model.scores(group))
                    group, held = [], 0
                group.append(t)
                held += len(t)
            if group:
                out.append(model.scores(group))
            yield pd.Series(np.clip(np.concatenate(out), 0, 1) if out else np.zeros(0))

    return score(F.coalesce(text, F.lit("")).cast("binary"))


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Per row: doc_id, held_out, score, predicted."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    scored = docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col)).alias("held_out"), score_column(model, F.col(text_col)).alias("score")
    )
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def drop_rejected(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows predicted to be of label 0, all their columns."""
    model = train(docs, labels, id_col=id_col, text_col=text_col, **options)
    return docs.where(score_column(model, F.col(text_col)) >= 0.5)
