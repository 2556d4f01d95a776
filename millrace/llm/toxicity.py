"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is.

A sentence's score is a logistic function of hashed words and word beginnings. A document's
probability is the noisy-or of its sentences, 1 - prod(1 - p), and the weights are trained from
document labels alone; the sentences that carry a document's probability are its offending ones.

Training takes at most ``fit_rows`` labelled texts of at most ``fit_chars`` characters: tasks read them
and count their features, and only where learnt ones occur comes to the driver, which finds the weights.
Scoring reads every whole text.

Defined results: null and empty text is one sentence without words; repeated rows get equal
scores; labels without a document or with a null label are not used; an empty table gives no rows;
without both labels among the fitted rows every document gets their mean, or 0 without any.
Columns in ``carry`` pass through, but for those named like a result, which replaces them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import apart, fresh, over_slices, release, remainder, staged, text_bytes
from millrace.llm.quality import labelled_rows, portions
from millrace.llm.scan import byte_set, segments, words

FIT_ROWS = 6_000
FIT_CHARS = 20_000
STEPS = 200
# A feature is learnt if it is in so many toxic documents, and so many times as common there.
LEAST_DOCS = 3
LEAST_LIFT = 15.0
# Log-odds of a sentence without any learnt feature.
UNKNOWN = -40.0
PREFIXES = (4, 5, 6)
ENDS = byte_set((10, 10), (33, 33), (46, 46), (63, 63))
LETTERS = byte_set((48, 57), (65, 90), (97, 122), (128, 255))


def instances(raw: np.ndarray, bounds: np.ndarray):
    """Start and row of each sentence, and the features of its words with the sentence of each."""
    starts, row = segments(raw, bounds, ENDS)
    at, hashes = words(raw, bounds, LETTERS, PREFIXES)
    sentence = np.searchsorted(starts, at, side="right") - 1
    # A word counts once in a sentence.
    order = np.lexsort((hashes[0], sentence))
    new = np.ones(len(order), bool)
    new[1:] = (np.diff(sentence[order]) != 0) | (hashes[0][order][1:] != hashes[0][order][:-1])
    once = np.sort(order[new])
    sentence, hashes = sentence[once], [h[once] for h in hashes]
    short = [(h >> np.uint64(32)).astype(np.uint32) for h in hashes]
    return starts, row.astype(np.int32), short, sentence.astype(np.int32)


@dataclass
class Model:
    # Sorted 32-bit hashes of the learnt words and beginnings, and their weights.
    keys: np.ndarray
    weights: np.ndarray
    constant: float

    def sentences(self, raw: np.ndarray, bounds: np.ndarray):
        starts, row, hashes, sentence = instances(raw, bounds)
        total = np.full(len(starts), self.constant)
        known = np.zeros(len(starts), bool)
        for h in hashes if len(self.keys) else ():
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            met = np.flatnonzero(self.keys[at] == h)
            total += np.bincount(sentence[met], self.weights[at[met]], len(starts))
            known[sentence[met]] = True
        return starts, row, np.where(known | (self.constant > 0), total, UNKNOWN)

    def score(self, raw: np.ndarray, bounds: np.ndarray):
        """Probability of each row, and its sentences: start, row and probability."""
        starts, row, total = self.sentences(raw, bounds)
        rows = len(bounds) - 1
        safe = -np.logaddexp(0, total)
        log_none = np.bincount(row, safe, rows)
        empty = np.bincount(row, minlength=rows) == 0
        log_none[empty] = -np.logaddexp(0, self.constant if self.constant > 0 else UNKNOWN)
        return -np.expm1(log_none), starts, row, -np.expm1(safe)


def train(texts: list[str], labels: list[int], steps: int = STEPS) -> Model:
    """Weights that maximise the likelihood of document labels under the noisy-or."""
    y = np.array(labels, float)
    if model := one_label(y):
        return model
    parts, before = [], 0
    for raw, bounds, first in portions(texts):
        starts, row, hashes, sentence = instances(raw, bounds)
        parts.append((row + np.int32(first), sentence + np.int32(before), hashes))
        before += len(starts)
    row, sentence = (np.concatenate([p[k] for p in parts]) for k in range(2))
    parts = [p[2] for p in parts]
    of_word, toxic = row[sentence], y.astype(np.int8)
    # Features that are no more frequent among toxic documents than among others are left out.
    keys, flat, where = [], [], []
    for kind in range(1 + len(PREFIXES)):
        h = np.concatenate([p[kind] for p in parts])
        for p in parts:
            p[kind] = None
        # Hash and document in one number, sorted in place.
        pairs = h.astype(np.uint64) << np.uint64(32)
        pairs |= of_word.view(np.uint32)
        pairs.sort()
        pairs = pairs[np.append(True, pairs[1:] != pairs[:-1])[:len(pairs)]]
        sorted_h = (pairs >> np.uint64(32)).astype(np.uint32)
        label = toxic[pairs & np.uint64(0xFFFFFFFF)]
        del pairs
        begin = np.flatnonzero(np.append(True, sorted_h[1:] != sorted_h[:-1]))[:len(sorted_h)]
        if not len(begin):
            continue
        with_toxic = np.add.reduceat(label, begin, dtype=np.int64)
        with_clean = np.diff(np.append(begin, len(label))) - with_toxic
        del label
        lift = (with_toxic + 0.5) / y.sum() * (1 - y).sum() / (with_clean + 0.5)
        chosen = sorted_h[begin][(lift >= LEAST_LIFT) & (with_toxic >= LEAST_DOCS)]
        if len(chosen):
            at = np.searchsorted(chosen, h)
            np.minimum(at, len(chosen) - 1, out=at)
            met = np.flatnonzero(chosen[at] == h)
            flat.append(at[met] + sum(map(len, keys)))
            where.append(sentence[met])
            keys.append(chosen)
    keys, flat, where = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, flat, where))
    return learnt(y, keys, flat, where, row, steps)


def one_label(y: np.ndarray) -> Model | None:
    """The model of rows that do not hold both labels."""
    if len(y) and y.min() != y.max():
        return None
    return Model(np.zeros(0, np.uint32), np.zeros(0), -40.0 if not len(y) or y[0] == 0 else 40.0)


def learnt(y: np.ndarray, keys: np.ndarray, flat: np.ndarray, where: np.ndarray, row: np.ndarray,
           steps: int) -> Model:
    """Weights of ``keys``, where key ``flat[i]`` occurs in sentence ``where[i]`` of ``row[where[i]]``."""
    size = len(keys)
    # Sentences without such a feature are not toxic, however many a document has.
    met, where = np.unique(where, return_inverse=True)
    row, n, rows = row[met], len(met), len(y)
    theta, constant = np.zeros(size), -4.0
    first, second = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        total = np.bincount(where, theta[flat], n) + constant
        p = 1 / (1 + np.exp(-np.clip(total, -40, 40)))
        none = np.exp(np.bincount(row, -np.logaddexp(0, total), rows))
        pull = np.where(y == 1, -none / np.maximum(1 - none, 1e-9), 1.0)[row] * p
        slope = np.append(np.bincount(flat, pull[where], size) + 1e-2 * theta, pull.sum())
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope * slope
        move = 0.1 * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)
        theta, constant = theta - move[:-1], constant - move[-1]
    order = np.argsort(keys)
    return Model(keys[order].astype(np.uint32), theta[order], float(constant))


def _counted(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Each feature of a row once, by kind, with the row's label."""
    starts, row, hashes, sentence = instances(*text_bytes(batch.column(0)))
    label, of_word = batch.column(1).to_numpy(zero_copy_only=False), row[sentence].view(np.uint32)
    found = [np.unique(h.astype(np.uint64) << np.uint64(32) | of_word) for h in hashes]
    pairs = np.concatenate(found)
    return pa.RecordBatch.from_arrays([
        pa.array(np.repeat(np.arange(len(found), dtype=np.int32), [len(f) for f in found])),
        pa.array((pairs >> np.uint64(32)).astype(np.int64)),
        pa.array(label[(pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)].astype(np.int32)),
    ], names=["kind", "hash", "label"])


def _occurrences(chosen: list[np.ndarray]):
    """Where learnt features occur: kind, number of the key, row, sentence of the row, place."""
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        starts, row, hashes, sentence = instances(*text_bytes(batch.column(0)))
        number = batch.column(1).to_numpy(zero_copy_only=False)
        first = np.searchsorted(row, np.arange(batch.num_rows))
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        before = 0
        for kind, (h, keys) in enumerate(zip(hashes, chosen)):
            at = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
            met = np.flatnonzero(keys[at] == h) if len(keys) else np.zeros(0, np.int64)
            r = row[sentence[met]]
            for column, values in zip(out, (
                    np.full(len(met), kind), at[met] + before, number[r], sentence[met] - first[r], met)):
                column.append(values.astype(np.int64))
            before += len(keys)
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(column)) for column in out],
            names=["kind", "key", "row", "sentence", "place"])
    return work


def train_on(rows: DataFrame, steps: int = STEPS) -> Model:
    """``train`` for rows of ``row`` (numbers from 0), ``text`` and ``label``, read twice by tasks."""
    y = np.array([r["label"] for r in rows.select("row", "label").orderBy("row").collect()], float)
    if model := one_label(y):
        return model
    each = rows.select("text", "label").mapInArrow(
        over_slices(_counted), "kind int, hash long, label int")
    counts = each.groupBy("kind", "hash").agg(
        F.sum("label").alias("with_toxic"), F.count_if(F.col("label") == 0).alias("with_clean"))
    lift = (F.col("with_toxic") + 0.5) / F.lit(float(y.sum())) * F.lit(float((1 - y).sum())) / (
        F.col("with_clean") + 0.5)
    known = counts.where((lift >= LEAST_LIFT) & (F.col("with_toxic") >= LEAST_DOCS)).select(
        "kind", "hash").toPandas()
    chosen = [np.sort(known["hash"][known["kind"] == kind].to_numpy().astype(np.uint32))
              for kind in range(1 + len(PREFIXES))]
    met = rows.select("text", "row").mapInArrow(
        over_slices(_occurrences(chosen)), "kind long, key long, row long, sentence long, place long"
    ).toPandas().sort_values(["kind", "row", "place"])
    # Sentences get numbers in the order of rows.
    pairs = met[["row", "sentence"]].to_numpy()
    sentences, where = np.unique(pairs, axis=0, return_inverse=True)
    return learnt(y, np.concatenate(chosen).astype(np.int64), met["key"].to_numpy(), where.reshape(-1),
                  sentences[:, 0], steps)


def fit(docs: DataFrame, labels: DataFrame, usable: Column, fit_rows: int = FIT_ROWS,
        fit_chars: int = FIT_CHARS) -> Model:
    picked = labelled_rows(docs, labels, "toxic", usable, fit_rows, fit_chars)
    number = F.row_number().over(Window.orderBy("h", "label", "text")) - 1
    rows = picked.select("text", "label", number.alias("row"))
    model = train_on(staged(rows.repartition(16, "row"), "toxic-sample"))
    release()
    return model


def score(docs: DataFrame, model: Model, carry: tuple[str, ...] = ("doc_id",),
          sentence_at: float = 0.5) -> DataFrame:
    """The carried columns, ``score``, and ``offending``: start, end (code points, end exclusive)
    and probability of each sentence whose own probability reaches ``sentence_at``."""
    source = docs.select(F.col("text").alias(fresh("text")), *apart(carry, "score", "offending"))
    spans = T.ArrayType(T.StructType([
        T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("score", T.DoubleType())]))
    fields = [*source.schema.fields[1:], T.StructField("score", T.DoubleType()),
              T.StructField("offending", spans)]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        raw, bounds = text_bytes(batch.column(0))
        found, starts, row, each = model.score(raw, bounds)
        marked: list[list[dict]] = [[] for _ in range(batch.num_rows)]
        hit = np.flatnonzero(each >= sentence_at)
        if len(hit):
            upto = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            ends = np.append(starts[1:], len(raw))
            for i in hit.tolist():
                zero = upto[bounds[row[i]]]
                marked[row[i]].append({
                    "start": int(upto[starts[i]] - zero), "end": int(upto[ends[i]] - zero),
                    "score": float(each[i])})
        of = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
        return pa.RecordBatch.from_arrays(
            [*batch.columns[1:], pa.array(found), pa.array(marked, of)],
            names=[f.name for f in fields])

    return source.mapInArrow(over_slices(work), T.StructType(fields))


def held_out() -> Column:
    """Rows whose labels are never learnt."""
    return F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))


def toxicity_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Query op8: the toxicity of every document."""
    model = fit(docs, labels, ~held_out())
    return score(docs, model).select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"))
