"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its evidence are the shares of kinds of bytes, word shapes and
repetitions of the line itself and of the lines before and after it; the chain's transitions tie
neighbouring labels. Forward-backward gives each line's probability of being good, and their mean
weighted by line length, calibrated on the fitted rows, is the document's score.

The field is fitted on the driver by gradient ascent on a sample of at most ``fit_rows`` labelled
documents of at most ``fit_chars`` characters, whose lines take the document's label. Scoring reads
every whole text.

Defined results: null and empty text is one empty line; repeated rows get equal scores; labels
without a document or with a null label are not used; an empty table gives no rows. Without
both labels among the fitted rows the score is their mean, or one half without any. Columns in
``carry`` pass through, but for one named ``score``, which the result replaces.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import apart, fresh, over_slices, release, remainder, text_bytes
from millrace.llm.scan import SPACES, byte_set, segments, words

FIT_ROWS = 4_000
FIT_CHARS = 20_000
STEPS = 80
NEWLINE = byte_set((10, 10))
# Kinds of bytes whose shares describe a line.
KINDS = [
    "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\n\f\v",
    ".,;:'\"-()", "!?", "#$%&*", "|", "<>{}[]=/\\_@^~`+",
]
KIND = np.zeros(256, np.int64)
for _i, _members in enumerate(KINDS):
    for _c in _members:
        KIND[ord(_c)] = _i + 1
KIND[128:] = len(KINDS) + 1
OWN = len(KINDS) + 2 + 5


def line_features(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features of each line, its row, and its length in bytes; an empty row is one empty line."""
    n = len(bounds) - 1
    starts, row = segments(raw, bounds, NEWLINE)
    sizes = np.diff(np.append(starts, len(raw)))
    kinds = len(KINDS) + 2
    own = np.zeros((len(starts), OWN))
    if len(starts):
        line = np.repeat(np.arange(len(starts)), sizes)
        tally = np.bincount(line * kinds + KIND[raw], minlength=len(starts) * kinds)
        own[:, :kinds] = tally.reshape(-1, kinds) / sizes[:, None]
        at, (h,) = words(raw, bounds, ~SPACES)
        of = np.searchsorted(starts, at, side="right") - 1
        count = np.bincount(of, minlength=len(starts))
        some = np.maximum(count, 1)
        again = np.zeros(len(at))
        again[1:] = (h[1:] == h[:-1]) & (of[1:] == of[:-1])
        order = np.lexsort((h, of))
        new = np.ones(len(at), bool)
        new[1:] = (h[order][1:] != h[order][:-1]) | (of[order][1:] != of[order][:-1])
        own[:, kinds] = np.bincount(of, again, len(starts)) / some
        own[:, kinds + 1] = np.bincount(of[order], new, len(starts)) / some
        own[:, kinds + 2] = np.log1p(count)
        own[:, kinds + 3] = np.log1p(sizes / some)
        # Share of words that begin with a capital.
        capital = (raw[at] >= 65) & (raw[at] <= 90)
        own[:, kinds + 4] = np.bincount(of, capital, len(starts)) / some
    empty = np.setdiff1d(np.arange(n), row)
    own = np.vstack([own, np.zeros((len(empty), OWN))])
    row, sizes = np.append(row, empty), np.append(sizes, np.ones(len(empty), np.int64))
    order = np.argsort(row, kind="stable")
    own, row, sizes = own[order], row[order], sizes[order]
    same = np.zeros(len(row), bool)
    same[1:] = row[1:] == row[:-1]
    before, after = np.zeros_like(own), np.zeros_like(own)
    before[1:] = own[:-1] * same[1:, None]
    after[:-1] = own[1:] * same[1:, None]
    edges = np.stack([~same, ~np.append(same[1:], False)], axis=1) if len(row) else np.zeros((0, 2))
    return np.hstack([own, before, after, edges]), row, sizes


def forward_backward(bias: np.ndarray, link: np.ndarray, row: np.ndarray, want_pairs: bool = False):
    """Probability that each line is good; with ``want_pairs`` also the expected transitions.

    ``bias`` is a line's log-odds of being good by itself, ``link[i, j]`` the weight of a label j
    after a label i. All documents advance together, one line a step, the longest first.
    """
    first = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.zeros(0, int)
    sizes = np.diff(np.append(first, len(row)))
    order = np.argsort(-sizes, kind="stable")
    first, sizes = first[order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    active = np.searchsorted(-sizes, -np.arange(1, longest + 1), side="right")
    forth, back = np.zeros((2, len(row))), np.zeros((2, len(row)))
    if longest:
        forth[1, first] = bias[first]
    for t in range(1, longest):
        i = first[:active[t]] + t
        f = forth[:, i - 1]
        forth[0, i] = np.logaddexp(f[0] + link[0, 0], f[1] + link[1, 0])
        forth[1, i] = np.logaddexp(f[0] + link[0, 1], f[1] + link[1, 1]) + bias[i]
    for t in range(longest - 1, 0, -1):
        i = first[:active[t]] + t
        b0, b1 = back[0, i], back[1, i] + bias[i]
        back[0, i - 1] = np.logaddexp(link[0, 0] + b0, link[0, 1] + b1)
        back[1, i - 1] = np.logaddexp(link[1, 0] + b0, link[1, 1] + b1)
    odds = (forth[1] + back[1]) - (forth[0] + back[0])
    good = 1 / (1 + np.exp(-np.clip(odds, -700, 700)))
    if not want_pairs:
        return good
    pairs = np.zeros((2, 2))
    inner = np.flatnonzero(np.append(False, row[1:] == row[:-1])) if len(row) else np.zeros(0, int)
    whole = np.logaddexp(forth[0] + back[0], forth[1] + back[1])
    for i in range(2):
        for j in range(2):
            pairs[i, j] = np.exp(
                forth[i, inner - 1] + link[i, j] + back[j, inner] + j * bias[inner] - whole[inner]
            ).sum()
    return good, pairs


@dataclass
class Field:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    constant: float
    link: np.ndarray
    # Calibration of a document's mean line probability: slope and intercept of its log-odds.
    slope: float
    intercept: float

    def lines(self, raw: np.ndarray, bounds: np.ndarray):
        found, row, sizes = line_features(raw, bounds)
        bias = (found - self.mean) / self.scale @ self.weights + self.constant
        return forward_backward(bias, self.link, row), row, sizes

    def score(self, raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        good, row, sizes = self.lines(raw, bounds)
        n = len(bounds) - 1
        share = np.bincount(row, good * sizes, n) / np.maximum(np.bincount(row, sizes, n), 1)
        return _logistic(self.slope * _log_odds(share) + self.intercept)


def _log_odds(p: np.ndarray) -> np.ndarray:
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _calibrate(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and intercept of a one-feature logistic regression, slightly shrunk."""
    beta = np.array([1.0, 0.0])
    design = np.stack([x, np.ones_like(x)], axis=1)
    for _ in range(30):
        p = _logistic(design @ beta)
        slope = design.T @ (p - y) + 1e-2 * beta
        curve = (design * (p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta = beta - np.linalg.solve(curve, slope)
    return float(beta[0]), float(beta[1])


def fit_field(texts: list[str], labels: list[int], steps: int = STEPS) -> Field:
    """Fit the field to labelled texts by Adam on the log-likelihood of their lines' labels."""
    parts = [(*line_features(raw, bounds), first) for raw, bounds, first in portions(texts)]
    found = np.vstack([p[0] for p in parts])
    row = np.concatenate([p[1] + p[3] for p in parts])
    sizes = np.concatenate([p[2] for p in parts])
    y = np.array(labels, float)
    if not len(y) or y.min() == y.max():
        p = float(y.mean()) if len(y) else 0.5
        zero = np.zeros(found.shape[1])
        return Field(zero, zero + 1, zero, 0.0, np.zeros((2, 2)), 0.0,
                     float(_log_odds(np.array(p))))
    mean, scale = found.mean(0), found.std(0) + 1e-3
    x = (found - mean) / scale
    of_line = y[row]
    inner = np.flatnonzero(np.append(False, row[1:] == row[:-1]))
    seen = np.zeros((2, 2))
    for label in (0, 1):
        seen[label, label] = (of_line[inner] == label).sum()
    theta = np.zeros(x.shape[1] + 5)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        link = theta[-4:].reshape(2, 2)
        good, pairs = forward_backward(x @ theta[:-5] + theta[-5], link, row, want_pairs=True)
        miss = of_line - good
        slope = np.concatenate([x.T @ miss, [miss.sum()], (seen - pairs).ravel()]) / len(y)
        slope -= 1e-3 * theta
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        theta = theta + 0.05 * (first / (1 - 0.9 ** step)) / (
            np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
    field = Field(mean, scale, theta[:-5], theta[-5], theta[-4:].reshape(2, 2), 1.0, 0.0)
    good = forward_backward(x @ field.weights + field.constant, field.link, row)
    share = np.bincount(row, good * sizes, len(y)) / np.bincount(row, sizes, len(y))
    field.slope, field.intercept = _calibrate(_log_odds(share), y)
    return field


def labelled_rows(docs: DataFrame, labels: DataFrame, label: str, usable: Column,
                  fit_rows: int, fit_chars: int) -> DataFrame:
    """``text``, ``label`` and ``h`` of at most ``fit_rows`` labelled texts, picked by a hash of their
    id and in the order of ``h``, ``label``, ``text``."""
    known = labels.select("doc_id", F.col(label).cast("int").alias("label"))
    known = known.where("doc_id is not null and label in (0, 1)").where(usable).distinct()
    # Ids are picked first; at most fit_rows of them go to the executors, and their texts come back.
    h = F.xxhash64("doc_id").alias("h")
    picked = known.select("doc_id", "label", h).orderBy("h", "doc_id", "label").limit(fit_rows)
    texts = docs.select("doc_id", F.col("text").alias("text")).where(
        F.coalesce(F.char_length("text"), F.lit(0)) <= fit_chars)
    return texts.join(F.broadcast(picked), "doc_id").orderBy("h", "label", "text").select(
        "text", "label", "h").limit(fit_rows)


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, usable: Column,
                    fit_rows: int, fit_chars: int) -> tuple[list[str], list[int]]:
    """The texts and labels of ``labelled_rows``."""
    rows = labelled_rows(docs, labels, label, usable, fit_rows, fit_chars).select("text", "label").collect()
    return [r["text"] for r in rows], [r["label"] for r in rows]


def portions(texts: list[str], most: int = 1_000_000) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """Bytes and bounds of a few texts at a time, and the number of the first."""
    first, size = 0, 0
    for i, text in enumerate([*texts, None]):
        if text is None and i == len(texts) or size > most:
            yield *text_bytes(pa.array([t or "" for t in texts[first:i]], pa.string())), first
            first, size = i, 0
        size += len(text or "")


def fit(docs: DataFrame, labels: DataFrame, usable: Column, fit_rows: int = FIT_ROWS,
        fit_chars: int = FIT_CHARS) -> Field:
    field = fit_field(*labelled_sample(docs, labels, "quality", usable, fit_rows, fit_chars))
    release()
    return field


def score(docs: DataFrame, field: Field, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The carried columns and ``score``, the probability that a text is good."""
    source = docs.select(F.col("text").alias(fresh("text")), *apart(carry, "score"))
    fields = [*source.schema.fields[1:], T.StructField("score", T.DoubleType())]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = field.score(*text_bytes(batch.column(0)))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(found)], names=[f.name for f in fields])

    return source.mapInArrow(over_slices(work), T.StructType(fields))


def held_out() -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(remainder("doc_id", 3) == 1, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query op4: the quality of every document."""
    field = fit(docs, labels, ~held_out())
    return score(docs, field).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
