"""Importance resampling against plain Python, and its SQL."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from millrace.llm import registry, resample
from tests.llm.conftest import SF_DIR, TEXTS

ODD = ["A b-c  d\n\ne_f", "É é\x80z 9", "  x ", "日本 語x Ab", "a b a b a b c", "\t", "zz　y z" * 50]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute(rows, target, most, buckets, seed, least, percent):
    def features(text):
        words = re.findall(resample.WORD, lowered(text))
        runs = [" ".join(words[i:i + k]) for k in range(1, most + 1)
                for i in range(len(words) - k + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    own = [features(t) for _, t in rows]
    s = Counter(b for _, found in own for b in found)
    t = Counter(b for x in target for b in features(x)[1])
    gain = [math.floor(1000 * math.log(
        (t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets))))
        for b in range(buckets)]
    out = []
    for (key, _), (n_words, found) in zip(rows, own):
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        name = f"{seed}:{'' if key is None else key}".encode()
        h = int(hashlib.sha256(name).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([key, len(found), weight, score, n_words])
    able = sorted((r for r in out if r[4] >= least),
                  key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    rank = {id(r): i + 1 for i, r in enumerate(able[:percent * len(able) // 100])}
    return sorted(([*r[:4], rank.get(id(r))] for r in out), key=str)


def test_words_and_offsets(spark):
    texts = [*ODD, *TEXTS]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    found = sorted((r["doc_id"], r["start"], r["end"], r["word"])
                   for r in resample.found_words(frame).collect())
    assert found == [(i, m.start(), m.end(), m.group()) for i, t in enumerate(texts)
                     for m in re.finditer(resample.WORD, lowered(t))]


@pytest.mark.parametrize("most, percent", [(1, 10), (3, 35), (2, 100)])
def test_draw_is_that_of_plain_python(docs, spark, most, percent):
    target = ["the river ran past", None, "", "日本 a b"]
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    found = resample.resample(docs, goal, most, 97, 5, 3, percent)
    assert found.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    # Two rows share an id, and their ranks may be swapped only if the texts are equal too.
    expected = brute(rows, target, most, 97, 5, 3, percent)
    assert sorted(([*r] for r in found.collect()), key=str) == expected


def test_empty_tables(docs, none, spark):
    empty = spark.createDataFrame([], "item_id long, text string")
    assert resample.resample(none, empty).count() == 0
    got = resample.resample(docs, empty, least_words=1, percent=50)
    assert got.count() == docs.count() and got.where("rank is not null").count() == 6


def test_many_rows_of_one_score_are_numbered_without_gaps(spark):
    one = spark.range(3_000).select(F.lit(7).alias("doc_id"), F.lit("w " * 30).alias("text"))
    ranks = [r[0] for r in resample.resample(one, one, percent=50).select("rank").collect() if r[0]]
    assert sorted(ranks) == list(range(1, 1_501))


def test_query_gives_the_rows_of_its_sql(spark):
    name = "op12_importance_resampling"
    rows = [tuple(r) for r in registry.queries()[name](spark, SF_DIR).collect()]
    base = duckdb.connect()
    for t in ("documents", "benchmark"):
        base.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    assert sorted(rows) == sorted(base.execute(registry.statements()[name]).fetchall())
