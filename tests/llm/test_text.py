"""Fingerprints, personal data, near duplicates and shards against brute force."""

import hashlib
import random
import re
import struct
import zlib
from itertools import pairwise

import pytest
import xxhash
from pyspark.sql import functions as F

from millrace.llm import neardup, ordermin, pii, sharding
from tests.llm.conftest import LONG, PLAIN, brute_components

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def signed(x):
    return x - (1 << 64) if x >= 1 << 63 else x


def xx(values, seed=42):
    for v, kind in values:
        raw = v.encode() if kind == "s" else struct.pack("<q" if kind == "l" else "<i", v)
        seed = xxhash.xxh64_intdigest(raw, seed=seed)
    return signed(seed)


def brute_tuples(text):
    words = [xx([(w, "s")]) for w in re.findall(r"[^ \t\n\x0b\f\r]{1,16}", text)]
    k, low = ordermin.KMER, ordermin.POSITION
    if len(words) >= k:
        kmers = [xx([(x, "l") for x in words[i:i + k]]) >> 24 for i in range(len(words) - k + 1)]
    else:
        kmers = [xx([(x, "l") for x in words]) >> 24] if words else []
    seen, numbered = {}, []
    for i, x in enumerate(kmers):
        seen[x] = seen.get(x, -1) + 1
        numbered.append((xx([(x, "l"), (seen[x], "i")]) & ~low) | i)
    sketch = sorted(numbered)[:ordermin.SKETCH]
    if not sketch:
        return [0] * ordermin.TUPLES
    out = []
    for r in range(ordermin.TUPLES):
        best = sorted((xx([(y >> 24, "l"), (r, "i")]) & ~low) | (y & low) for y in sketch)[:2]
        best.sort(key=lambda y: y & low)
        out.append(xx([(y >> 24, "l") for y in best]))
    return out


def test_order_minhash_is_the_method(docs):
    rows = ordermin.fingerprints(docs).where("doc_id not in (10, 11)").collect()
    for r in rows:
        assert list(r["tuples"]) == brute_tuples(r["text"]), r["text"][:40]
        assert r["fingerprint"] == "".join(f"{x & 0xFFFFFFFF:08x}" for x in r["tuples"])


def test_edited_neighbours_in_a_ring(real, docs, none, spark):
    rows = {r["doc_id"]: r for r in ordermin.edited_pairs(real).collect()}
    texts = dict(real.select("doc_id", F.coalesce("text", F.lit(""))).collect())
    order = sorted(texts, reverse=True)
    for a, b in pairwise([*order, order[0]]):
        half = len(texts[a]) // 2
        edited = texts[a][:len(texts[a]) - half] + texts[b][:half]
        r = rows[a]
        assert r["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        assert r["n_chars"] == len(texts[a])
        same = [x == y for x, y in zip(brute_tuples(texts[a]), brute_tuples(edited))] if a < 20 else None
        if same:
            assert r["near_edited"] == pytest.approx((sum(same) / len(same)) ** 0.5)
        assert 0 <= r["near_next"] <= 1
        assert r["fingerprint"] == rows[a]["fingerprint"]
    assert ordermin.edited_pairs(docs).count() == docs.count()
    assert ordermin.edited_pairs(none).count() == 0
    one = ordermin.edited_pairs(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one["edited_sha256"] == hashlib.sha256(b"abab").hexdigest()


def test_order_counts(spark):
    words = PLAIN.split()
    moved = " ".join(words[20:] + words[:20])
    rnd = random.Random(2)
    triples = [words[i:i + 3] for i in range(0, len(words) - 2, 3)]
    rnd.shuffle(triples)
    rows = [(1, PLAIN), (2, moved), (3, " ".join(sum(triples, [])))]
    f = ordermin.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    t = {r["doc_id"]: list(r["tuples"]) for r in f.collect()}
    near = [sum(x == y for x, y in zip(t[1], t[i])) for i in (2, 3)]
    assert len(t[1]) > near[0] > near[1]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def brute_spans(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m.group())
            fine = {
                "email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m.group().split(".")),
                "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15,
            }[kind]
            if fine:
                found.append((m.start(), rank, m.end(), kind))
    return [f"{k}:{a}:{b}" for a, _, b, k in sorted(found)]


HARD = [
    "", "x" * 2_000, "1 " * 2_000, "a@" + "b." * 2_000 + "c", "1." * 2_000 + "1", "+1" * 2_000,
    "x@y@z.com a@b.com_z@w.com a@b.com..x@y.z @a.b a@b a@b.", "1.2.3.4.5.6.7.8 256.1.1.1 01.002.3.4 1.2.3",
    "4041894974608795 4041-8949-7460-8795 4041 8949 7460 8795 1 2 3 5--6 40418949746087951",
    "+1 (988) 555-2485) +49 30 1234567-- +1 2 +1234567890123456 ++1 234 567 8901 2", "\x01a@b.c\x02 é 😀 1.2.3.4",
    "e 😀😀 q.w@e.r +1 (988) 555-2485 4041894974608795\n10.20.30.40 a.b@c.d",
    "card 4 0 4 1 8 9 4 9 7 4 6 0 8 7 9 5", "card 4-0-4-1-8-9-4-9-7-4-6-0-8-7-9-5 x",
]


def test_base_spans(spark, real, docs, none):
    frame = spark.createDataFrame(list(enumerate(HARD)), "doc_id long, text string")
    nothing = pii.Trees(None, {})
    for source in (frame, real.select("doc_id", "text"), docs.where("doc_id is not null")):
        text_of = dict(source.select("doc_id", "text").collect())
        for r in pii.find(source, nothing).withColumn("list", pii.listed("base")).collect():
            assert r["list"] == ",".join(brute_spans(text_of[r["doc_id"]])), r["doc_id"]
    assert pii.personal_data(none).count() == 0


def test_long_runs_cost_neither_stack_nor_squares(spark):
    rows = list(enumerate([
        "x" * 300_000, "1 " * 100_000, "a@" + "b." * 100_000 + "c", "1." * 10_000 + "1", "+1" * 100_000]))
    found = pii.find(spark.createDataFrame(rows, "doc_id long, text string"), pii.Trees(None, {}))
    sizes = {r[0]: r[1] for r in found.select("doc_id", F.size("base")).collect()}
    assert sizes == {0: 0, 1: 0, 2: 1, 3: 2_500, 4: 0}


def test_surroundings_are_those_of_the_text(spark):
    rnd = random.Random(6)
    parts = ["1234567", "(98) 765.4321", "12", "é", " x ", "\n", "a" * 30, "+1 200 300 400", "😀"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 60))) for _ in range(60)]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").select(
        "t", pii._pieces("near_number").alias("p_near_number"))
    for r in frame.select("t", pii._spans("near_number", True).alias("found")).collect():
        for m in r["found"] or []:
            assert r["t"][m["start"]:m["end"]] == m["m"]
            assert m["before"] == r["t"][max(m["start"] - pii.CONTEXT, 0):m["start"]]
            assert m["after"] == r["t"][m["end"]:m["end"] + pii.CONTEXT]


def test_many_spans_in_one_text(spark):
    """Each text has 60,000 spans or matches; the work grows with their number alone."""
    busy = ", ".join(f"é {i} +1 988 555 {i % 9000 + 1000} a{i}@b.org" for i in range(30_000))
    idle = " ".join(f"w{i % 977}x{i % 13}" for i in range(30_000))
    frame = spark.createDataFrame([(1, busy), (2, idle)], "doc_id long, text string")
    found = pii.find(frame, pii.Trees("1D", {"phone": 0.5, "email": 0.5}), ("doc_id", "text"))
    rows = {r["doc_id"]: r for r in found.select(
        "doc_id", F.size("base").alias("n"), pii.redacted("text", "spans").alias("clean")).collect()}
    assert rows[1]["n"] == 60_000
    assert rows[1]["clean"] == ", ".join(f"é {i} [PHONE] [EMAIL]" for i in range(30_000))
    assert rows[2]["clean"] == idle


def test_overlaps_and_order_by_plain_loops(spark):
    rnd = random.Random(8)
    schema = ("base array<struct<kind string, rank int, start int, end int>>, "
              "spans array<struct<kind string, rank int, start int, end int>>")
    rows = []
    for n in (0, 1, 5, 40, 700):
        base = [("ip", rnd.randint(0, 3), a := rnd.randint(0, 8 * n), a + rnd.randint(1, 9))
                for _ in range(n)]
        at, follow = 0, []
        for _ in range(n):
            at += rnd.randint(0, 5)
            follow.append(("email", 0, at, at := at + rnd.randint(1, 6)))
        rows += [(base, follow), ([], follow), (base, [])]
    frame = spark.createDataFrame(rows, schema).select(
        "base", "spans", F.expr(pii.overlapping("base", "spans")).alias("reach"),
        F.expr(pii.in_order("concat(base, base, spans)")).alias("sorted"))
    for r in frame.collect():
        hits = [reach > s["start"] for reach, s in zip(r["reach"], r["spans"], strict=True)]
        assert hits == [any(b["start"] < s["end"] and s["start"] < b["end"] for b in r["base"])
                        for s in r["spans"]]
        assert [(x["start"], x["rank"], x["end"], x["kind"]) for x in r["sorted"]] == sorted(
            {(x["start"], x["rank"], x["end"], x["kind"]) for x in r["base"] + r["spans"]})


def test_no_number_with_a_wrong_check_digit_is_added(spark):
    frame = spark.createDataFrame(
        [(1, "no 4041 8949 7460 8796 here"), (2, "no 4041894974608796 here")], "doc_id long, text string")
    every = pii.Trees("1D", {"card": 0.5, "phone": 0.5, "email": 0.5})
    assert [r[0] for r in pii.find(frame, every).select(pii.listed("spans")).collect()] == ["", ""]


def test_query_keeps_the_base_spans(real):
    text_of = dict(real.select("doc_id", "text").collect())
    for r in pii.personal_data(real).collect():
        base = brute_spans(text_of[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r["spans"].split(",")) | {""}
        assert r["n_email"] == sum(x.startswith("email") for x in base)


def test_trees_add_spans_and_redact(spark):
    rows = [(i, f"call +1 (9{i % 90 + 10}) 555-{1000 + i} or see page {i} of 7.1 and 2024-10-{i % 28 + 1:02d} 1")
            for i in range(300)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    trees = pii.fit(frame, precision=0.9)
    assert trees.margin and "phone" in trees.thresholds
    lone = spark.createDataFrame([(1, "x (988) 555-2485 y a [at] b.org 1.2.3.4 end"), (2, None)],
                                 "doc_id long, text string")
    every = pii.Trees("1D", {"phone": 0.5, "email": 0.5})
    found = pii.find(lone, every, ("doc_id", "text")).withColumns({
        "list": pii.listed("spans"), "clean": pii.redacted("text", "spans")})
    got = {r["doc_id"]: (r["list"], r["clean"]) for r in found.collect()}
    assert got[1] == ("phone:2:16,email:19:31,ip:32:39", "x [PHONE] y [EMAIL] [IP] end")
    assert got[2] == ("", None)
    text = "é 4041 8949 7460 8795 and +1 (988) 555-2485."
    one = spark.createDataFrame([(1, text)], "doc_id long, text string")
    clean = pii.find(one, pii.Trees(None, {}), ("text",)).select(pii.redacted("text", "spans")).first()[0]
    assert clean == "é [CARD] and [PHONE]."


@pytest.mark.parametrize("every", [0, 2])
def test_fitted_trees_add_what_the_base_form_lacks(spark, every):
    """``every``: one in so many numbers of the sample stands without its prefix."""
    rows = [(i, f"call {'' if every and i % every == 0 else '+1 '}(9{i % 90 + 10}) 555-{1000 + i} now or write to "
                f"ann{i}@host{i % 7}.org today, see page {i} of 2024-10-{i % 28 + 1:02d} 1 end") for i in range(600)]
    trees = pii.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    text = "call (988) 555-2485 now or write to bob [at] host3 [dot] org today, see page 5 of 2024-10-07 1 end"
    lone = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = pii.find(lone, trees).select(pii.listed("base"), pii.listed("spans")).first()
    at = text.index("bob")
    assert tuple(found) == ("", f"phone:5:19,email:{at}:{at + len('bob [at] host3 [dot] org')}")


@pytest.mark.parametrize("width", [4, 5])
def test_components(spark, real, docs, none, width):
    rnd = random.Random(width)
    words = [f"v{i}" for i in range(400)]
    rows, base = [], [rnd.choice(words) for _ in range(120)]
    for i in range(60):  # a group of near copies, each off by a few words, and copies of copies
        own = list(base if i % 3 else rows[-1][1].split() if rows else base)
        for _ in range(rnd.randint(0, 8)):
            own[rnd.randrange(len(own))] = rnd.choice(words)
        rows.append((1000 - i, " ".join(own)))
    rows += [(2000 + i, " ".join(base[:50] + [rnd.choice(words) for _ in range(40)])) for i in range(40)]
    crafted = spark.createDataFrame(rows, "doc_id long, text string")
    for source in (crafted, real.select("doc_id", "text"), docs.select("doc_id", "text")):
        given = [tuple(r) for r in source.collect()]
        want = sorted(map(str, zip(*zip(*given), brute_components(given, width))))
        found = neardup.near_duplicates(source, width, carry=("text",)).collect()
        assert sorted(str((r["doc_id"], r["text"], (r["n_shingles"], r["component_id"])))
                      for r in found) == want
        assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)
        singles = [r for r in found if r["single"]]
        assert len(singles) == len({r["component_id"] for r in found if r["n_shingles"]}) + sum(
            not r["n_shingles"] for r in found)
    assert neardup.linked_documents(none).count() == 0


def test_a_group_alike_but_not_enough(spark):
    """Texts of one origin, alike at 0.55 to 0.9: no link is lost, and few pairs are compared."""
    rnd = random.Random(12)
    base = [f"v{rnd.randrange(4_000)}" for _ in range(150)]
    rows = []
    for i in range(400):
        own = list(base)
        for k in range(rnd.choice([1, 2, 6, 8, 10, 12])):
            own[rnd.randrange(len(own))] = f"own{i}x{k}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = [(d, *c) for (d, _), c in zip(rows, brute_components(rows, 4))]
    tried, meetings = [], neardup._meetings
    neardup._meetings = lambda *a: tried.append(meetings(*a)) or tried[-1]
    try:
        found = neardup.linked_documents(frame).select("doc_id", "n_shingles", "component_id")
        assert sorted(tuple(r) for r in found.collect()) == want
    finally:
        neardup._meetings = meetings
    groups = len({c for _, _, c in want})
    print(f"{tried[0].count()} pairs compared of {400 * 399 // 2}, {groups} groups")
    assert 50 < groups < 350 and tried[0].count() < 4_000


def test_rare_postings_meet_every_partner(spark):
    rnd = random.Random(3)
    sets = [sorted({rnd.randrange(60) for _ in range(rnd.randint(1, 40))}) for _ in range(80)]
    sets += [sorted({*s, 100 + i} - {s[0]}) for i, s in enumerate(sets[:40])]
    frame = spark.createDataFrame(
        [(str(i).encode(), s) for i, s in enumerate(sets)], "set_key binary, hashes array<long>")
    posted = neardup._rare_postings(frame, 80)
    none = spark.createDataFrame([], "node binary, component binary")
    met = {(int(r["a"]), int(r["b"])) for r in neardup._meetings(posted, none, 80).collect()}
    met |= {(b, a) for a, b in met}
    for i, a in enumerate(map(set, sets)):
        for j, b in enumerate(map(set, sets)):
            if i != j and a != b and 100 * len(a & b) >= 80 * len(a | b):
                assert (i, j) in met


def test_copies_of_one_text_meet_it_and_not_each_other(spark, monkeypatch):
    """Copies with one to six changes: those near enough to the text are linked to it in linear work."""
    rnd = random.Random(21)
    base = [f"v{rnd.randrange(4_000)}" for _ in range(150)]
    rows = [(0, " ".join(base))]
    for i in range(1, 500):
        own = list(base)
        for k in range(1 + i % 6):
            own[rnd.randrange(len(own))] = f"own{i}x{k}"
        rows.append((i, " ".join(own)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    want = [(d, *c) for (d, _), c in zip(rows, brute_components(rows, 4))]
    tried, meetings = [], neardup._meetings
    monkeypatch.setattr(neardup, "_meetings", lambda *a: tried.append(meetings(*a)) or tried[-1])
    found = neardup.linked_documents(frame).select("doc_id", "n_shingles", "component_id")
    assert sorted(tuple(r) for r in found.collect()) == want
    print(f"{tried[0].count()} pairs compared, {len({c for _, _, c in want})} groups")
    assert tried[0].count() < 100


def test_parities_leave_out_only_pairs_that_differ_too_much(spark):
    rnd = random.Random(23)
    core = [rnd.randrange(-1 << 62, 1 << 62) for _ in range(150)]
    sets = [sorted({*rnd.sample(core, 150 - k), *(rnd.randrange(-1 << 62, 1 << 62) for _ in range(k))})
            for k in (rnd.randrange(16) for _ in range(60))]
    frame = spark.createDataFrame(
        [(str(i).encode(), s) for i, s in enumerate(sets)], "set_key binary, hashes array<long>")
    none = spark.createDataFrame([], "node binary, component binary")
    met = {(int(r["a"]), int(r["b"])) for r in neardup._meetings(
        neardup._rare_postings(frame, 80), none, 80).collect()}
    met |= {(b, a) for a, b in met}
    near = {(i, j) for i, a in enumerate(map(set, sets)) for j, b in enumerate(map(set, sets))
            if i != j and 100 * len(a & b) >= 80 * len(a | b)}
    assert near <= met and 0 < len(met - near) < len(near) / 4


def test_hypergeometric_matrix():
    rnd = random.Random(5)
    draws = [sharding.hypergeometric(30, 100, 20, rnd.random()) for _ in range(20_000)]
    mean = sum(draws) / len(draws)
    spread = sum((x - mean) ** 2 for x in draws) / len(draws)
    assert mean == pytest.approx(6, abs=0.06) and spread == pytest.approx(20 * 0.3 * 0.7 * 80 / 99, rel=0.05)
    rows, shards = [0, 7, 100, 3], [28, 28, 27, 27]
    matrix = sharding.communication_matrix(rows, shards, 1)
    assert [sum(r) for r in matrix] == rows and [sum(c) for c in zip(*matrix)] == shards


def test_shards(real, docs, none):
    for source, shards in ((real, 40), (docs, 3), (docs, 40)):
        rows = sharding.shuffle_into_shards(source, shards, block_rows=2).collect()
        assert len(rows) == source.count()
        slots = {}
        for r in rows:
            slots.setdefault(r["shard"], []).append(r["slot"])
        sizes = [len(slots.get(i, [])) for i in range(shards)]
        assert max(sizes) - min(sizes) <= 1
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        again = sharding.shuffle_into_shards(source.repartition(5), shards, block_rows=2)
        assert sorted((str(r["doc_id"]), str(r["text"]), r["shard"]) for r in again.collect()) == sorted(
            (str(r["doc_id"]), str(r["text"]), r["shard"]) for r in rows)
    text_of = {r["doc_id"]: r["text"] or "" for r in real.collect()}
    for r in sharding.sharded(real).collect():
        raw = text_of[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"], r["law"]) == (len(raw) + 16, zlib.crc32(raw), "rows")
    assert sharding.sharded(none).count() == 0
    assert len(LONG) > 100_000


def test_trees_learn_from_every_document(spark, monkeypatch):
    docs = spark.range(20_500).selectExpr("id doc_id", "concat('call 555 123 ', 1000 + id % 9000) text")
    kept = []
    monkeypatch.setattr(pii, "staged", lambda df, *more: kept.append(df) or df)
    assert pii.fit(docs).margin is None
    assert kept[0].count() == 20_500
