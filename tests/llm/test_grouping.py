"""Grouping genetic packing: exact pieces, valid groupings, few sequences."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import grouping, registry
from tests.llm.conftest import SF_DIR

# These fill eight bins of 100 exactly; best fit in falling order takes nine.
TRICKY = [51, 12, 20, 17, 2, 2, 4, 92, 50, 13, 27, 10, 54, 8, 9, 29, 27, 40, 13, 20, 4, 51, 29, 16,
          9, 9, 65, 17, 8, 22, 23, 47]


def counts_of(bins):
    return Counter(s for b in bins for s in b)


def test_children_hold_every_piece_once():
    rng = np.random.default_rng(4)
    for n in (1, 2, 30, 400):
        lengths = rng.integers(1, 100, n).tolist()
        parents = grouping.founders(lengths, 100, rng)
        for _ in range(20):
            child = grouping.crossover(
                parents[0], parents[-1], np.bincount(lengths, minlength=101), 100, rng)
            assert counts_of(child) == Counter(lengths) and max(map(sum, child)) <= 100
            assert all(child)
            parents = [child, *parents[:3]]


def test_best_fit_is_that_of_a_plain_search():
    rng = np.random.default_rng(5)
    for _ in range(50):
        items = rng.integers(1, 60, 40).tolist()
        free = []
        for s in items:
            fitting = [f for f in free if f >= s]
            if fitting:
                free.remove(min(fitting))
            free.append((min(fitting) if fitting else 100) - s)
        bins = grouping.best_fit(items, [], 100)
        assert sorted(100 - sum(b) for b in bins) == sorted(free)


def test_evolution_beats_its_founders():
    rng = np.random.default_rng(1)
    first = grouping.evolve(TRICKY, [], 100, 0, rng)
    assert len(first[0]) == 9
    last = grouping.evolve(TRICKY, first, 100, 600, rng)
    assert len(last[0]) == 8 == grouping.least_bins(TRICKY, 100)
    assert counts_of(last[0]) == Counter(TRICKY)


def test_groupings_survive_their_bytes():
    for bins in ([], [[1]], [[3, 4], [5], [1, 1, 1]]):
        assert grouping.from_bytes(grouping.to_bytes(bins)) == bins


def test_elite_moves_to_the_next_island(spark):
    rows = [(7, i, [1], [1], [bytes([i]), b"x"], 1, False) for i in range(3)]
    moved = grouping.migrated(spark.createDataFrame(rows, grouping.ISLAND), 3).collect()
    assert {r["island"]: [bytes(p) for p in r["population"]] for r in moved} == {
        i: [bytes([i]), b"x", bytes([(i + 2) % 3])] for i in range(3)}


def placed(spark, lengths, capacity, **search):
    frame = spark.createDataFrame(list(enumerate(lengths)), "key long, length long")
    rows = grouping.group(frame, capacity, **search).collect()
    assert sorted(r["key"] for r in rows) == list(range(len(lengths)))
    bins = defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], lengths[r["key"]]))
    for b in bins.values():
        at = 0
        for offset, size in sorted(b):
            assert offset == at
            at += size
        assert at <= capacity
    return len(bins)


def test_islands_and_levels_give_few_sequences(spark):
    rng = np.random.default_rng(2)
    lengths = np.minimum(rng.lognormal(3.2, 1, 3_000).astype(int) + 1, 100).tolist()
    whole = placed(spark, lengths, 100, deme_pieces=250)
    assert whole <= grouping.least_bins(lengths, 100) * 1.01 + 1
    assert placed(spark, TRICKY, 100, generations=600) == 8
    # A third of all pieces alike, and pieces of which no two share a bin.
    assert placed(spark, [40] * 900 + [60] * 900 + [100] * 200, 100, deme_pieces=200) <= 1_112
    assert placed(spark, [51] * 50, 100) == 50
    assert placed(spark, [1], 100) == 1


def expected_pieces(texts, capacity):
    made = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    made.encode_special_tokens = True
    out = []
    for doc_id, text in texts:
        ids = [*made.encode(text or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            raw = np.array(ids[at:at + capacity], "<u4").tobytes()
            out.append((doc_id, k, at, len(raw) // 4, zlib.crc32(raw)))
    return sorted(out, key=str)


def checked(rows, texts, capacity=grouping.CAPACITY):
    names = ("doc_id", "piece", "start", "length", "ids_crc32")
    assert sorted((tuple(r[n] for n in names) for r in rows), key=str) == \
        expected_pieces(texts, capacity)
    ends = defaultdict(list)
    for r in rows:
        ends[r["sequence_id"]].append((r["offset"], r["length"]))
    for b in ends.values():
        b.sort()
        assert [o for o, _ in b] == [sum(s for _, s in b[:i]) for i in range(len(b))]
        assert sum(s for _, s in b) <= capacity
    return len(ends)


def test_hard_rows(docs, none):
    texts = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    assert checked(grouping.best_fit_pieces(docs).collect(), texts) > 100
    packed = grouping.pack(docs, capacity=50, deme_pieces=20)
    rows = packed.collect()
    checked(rows, texts, 50)
    whole = {r["sequence_id"]: bytes(r["ids"]) for r in grouping.sequences(packed).collect()}
    for r in rows:
        begin = 4 * r["offset"]
        assert whole[r["sequence_id"]][begin:begin + 4 * r["length"]] == bytes(r["ids"])
    assert sum(map(len, whole.values())) == sum(4 * r["length"] for r in rows)
    assert grouping.best_fit_pieces(none).count() == 0


def test_query_on_the_table(spark, real):
    found = registry.queries()["op13_grouping_packing"](spark, SF_DIR)
    texts = [tuple(r) for r in real.select("doc_id", "text").collect()]
    used = checked(found.collect(), texts)
    tokens = found.agg(F.sum("length")).first()[0]
    assert used <= -(-tokens // grouping.CAPACITY) + 1
