"""Token operators against the libraries themselves: ids, decoding, packing, files."""

import base64
import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import packing, simple8b, tokens
from millrace.session import new_folder
from tests.llm.conftest import TEXTS

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
PARTS = ["a", "B", "é", " ", "  ", "\n", "\t", "\x1c", "\x85", "　", "'s", "'", "1", "²", "ا",
         "日本", "😀", "é", "!", "<|endoftext|>", "...", ".", ",", "\r\n", " ", "\x00", "_"]


@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def whole(name, texts):
    made = Tokenizer.from_file(public_tokenizers.path(name))
    made.encode_special_tokens = True
    return [np.array(x.ids, "<u4").tobytes()
            for x in made.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def odd_texts():
    rnd = random.Random(3)
    return ["".join(rnd.choice(PARTS) for _ in range(rnd.randint(0, 60))) for _ in range(400)] + [
        "".join(map(chr, range(i, i + 97))) for i in range(0, 0x3400, 97)]


def test_ids_are_those_of_the_libraries(library):
    texts = odd_texts()
    column = pa.array(texts)
    by_rank = tokens.rank_encoder(RANKS, public_tokenizers.PATTERN).encode(column)
    assert by_rank == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in texts]
    for name, drops in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        found = tokens.file_encoder(public_tokenizers.path(name), drops).encode(column)
        assert found == whole(name, texts), name


def swapped():
    """Unbroken texts of the same bytes, in which stretches of 256 bytes have changed places."""
    rnd = random.Random(9)
    x, y = ("".join(rnd.choice("abcdefghij") for _ in range(256)) for _ in range(2))
    return [x + y, y + x, x + y + x, x + x + y, x + y]


def test_long_chunks_are_told_apart(library):
    column = pa.array(swapped())
    by_rank = tokens.rank_encoder(RANKS, public_tokenizers.PATTERN).encode(column)
    assert by_rank == [np.array(library.encode_ordinary(t), "<u4").tobytes() for t in swapped()]
    for name, drops in (("byte_bpe_50k.json", False), ("word_bpe_49k.json", True)):
        found = tokens.file_encoder(public_tokenizers.path(name), drops).encode(column)
        assert found == whole(name, swapped()) and found[0] != found[1], name


def test_equal_hashes_of_unequal_chunks_change_nothing(monkeypatch):
    monkeypatch.setattr(tokens, "mixed", lambda h: h & np.uint64(7))
    texts = odd_texts()[:200] + swapped()
    made = tokens.Encoder(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), False)
    assert made.encode(pa.array(texts)) == whole("byte_bpe_50k.json", texts)


def test_queries_by_the_libraries_alone(docs, spark, library):
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()] + list(enumerate(swapped(), 100))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    expected = []
    for key, text in rows:
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, "<u4").tobytes()
        expected.append((key, len(ids), hashlib.sha256(raw).hexdigest(),
                         hashlib.sha256((text or "").encode()).hexdigest()))
    found = [tuple(r) for r in tokens.round_trip(frame).collect()]
    assert sorted(found, key=str) == sorted(expected, key=str)

    ids_of = {k: i + b"\x01\0\0\0" for (k, _), i in zip(
        rows, whole("word_bpe_49k.json", [t for _, t in rows]))}
    copies, pieces = Counter(k for k, _ in rows), defaultdict(list)  # rows of one id are alike
    for r in packing.packed_pieces(frame).collect():
        ids = ids_of[r["doc_id"]]
        cut = ids[4 * r["start"]:4 * (r["start"] + r["length"])]
        assert r["ids_crc32"] == zlib.crc32(cut) and len(cut) == 4 * r["length"]
        assert r["doc_tokens"] == len(ids) // 4
        pieces[r["doc_id"]].append((r["start"], r["start"] + r["length"]))
    assert pieces.keys() == ids_of.keys()
    for key, found in pieces.items():
        found.sort()
        assert all(found.count(p) == copies[key] for p in found)
        ends = sorted(set(found))
        assert [a for a, _ in ends] == [0, *(b for _, b in ends[:-1])]
        assert ends[-1][1] == len(ids_of[key]) // 4


def test_full_dictionary_changes_nothing(monkeypatch):
    texts = odd_texts()[:100]
    monkeypatch.setattr(tokens, "CACHE_CHUNKS", 5)
    made = tokens.Encoder(Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")), False)
    for _ in range(2):
        assert made.encode(pa.array(texts)) == whole("byte_bpe_50k.json", texts)
    assert len(made.known) < 1_000


def test_round_trip_of_hard_rows(docs, none, library):
    rows = tokens.decode(tokens.encode(docs), with_text=True).collect()
    text_of = dict(docs.where("doc_id is not null").select("doc_id", "text").collect())
    for r in (r for r in rows if r["doc_id"] is not None):
        text = text_of[r["doc_id"]] or ""
        assert bytes(r["decoded"]) == text.encode() and r["text"] == text
        assert np.frombuffer(r["ids"], "<u4").tolist() == library.encode_ordinary(text)
    assert len(rows) == docs.count()
    assert tokens.round_trip(none).count() == 0


def test_offsets_and_split_characters(spark):
    text = "né 😀 日本語 x"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    row = tokens.encode(frame, with_offsets=True).first()
    ids, starts, ends = np.frombuffer(row["ids"], "<u4"), row["starts"], row["ends"]
    table = tokens.token_table(RANKS)[0]
    done, raw = 0, text.encode()
    for i, a, b in zip(ids, starts, ends):
        end = done + len(table[i])
        first = len(raw[:done + 1].decode(errors="ignore")) - (1 if raw[done] & 0xC0 != 0x80 and raw[done] < 0x80 else 0)
        assert text[a:b].encode().find(table[i]) >= 0 and a <= first + 1
        done = end
    assert starts[0] == 0 and ends[-1] == len(text)
    assert any(b - a == 1 and len(table[i]) < len(text[a:b].encode())
               for i, a, b in zip(ids, starts, ends)), "no id holds only part of a character"
    half = frame.select("doc_id", F.lit(table[ids[2]][:1]).alias("x"))
    first_byte = np.array([tokens.read_ranks(RANKS)[b"\xf0"]], "<u4").tobytes()
    lone = half.select("doc_id", F.lit(bytearray(first_byte)).alias("ids"))
    assert tokens.decode(lone, with_text=True).first()["text"] == "�"


@pytest.mark.parametrize("high", [1, 2, 50_257, 1 << 30, (1 << 63)])
def test_simple8b_round_trip(high):
    rnd = np.random.default_rng(1)
    for n in (0, 1, 239, 241, 1023, 1024, 1025, 9_000):
        ids = rnd.integers(0, high, n, dtype=np.uint64)
        if n > 1000:
            ids[5:400] = 0
            ids[rnd.integers(0, n, 9)] = rnd.choice(
                np.array([(1 << 60) - 1, (1 << 64) - 1, 7], np.uint64), 9)
        words, blocks, escapes = simple8b.pack(ids)
        assert (simple8b.unpack(words, blocks, escapes, n) == ids).all()
        assert len(words) <= n


def test_files_hold_every_document(docs, none):
    spark, folder = docs.sparkSession, new_folder(docs.sparkSession, "ids")
    simple8b.write_ids(docs, folder, row_ids=100)
    rows = simple8b.read_ids(spark, folder).collect()
    assert sum(len(r["ids"]) for r in rows) // 4 == max(r["start"] + len(r["ids"]) // 4 for r in rows)
    rows.sort(key=lambda r: r["start"])
    known = [r["doc_id"] for r in rows]
    assert known == sorted(known, key=lambda d: (d is not None, d))
    end = np.array([0], "<u4").tobytes()
    expected = dict(enumerate(x + end for x in whole("byte_bpe_50k.json", TEXTS)))
    at = 0
    for r in rows:
        assert r["start"] == at
        at += len(r["ids"]) // 4
        assert r["doc_id"] is None or bytes(r["ids"]) == expected[r["doc_id"]]
    assert simple8b.written_and_read(none).count() == 0


def check_pieces(rows, expected):
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    for doc, ids in expected.items():
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        assert b"".join(bytes(r["ids"]) for r in pieces) == ids
        assert {r["doc_tokens"] for r in pieces} == {len(ids) // 4}
    waste = total = 0
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r["offset"]):
            assert r["offset"] == at and len(r["ids"]) == 4 * r["length"] > 0
            at += r["length"]
        assert at <= 2048
        total += at
        waste += 0 if at & (at - 1) == 0 else 2048 - at
    return waste / total


def test_packing_covers_every_id(real, docs, none):
    texts = dict(real.select("doc_id", "text").collect())
    end = np.array([1], "<u4").tobytes()
    ids = dict(zip(texts, (x + end for x in whole("word_bpe_49k.json", texts.values()))))
    rows = packing.pack(real).collect()
    assert check_pieces(rows, ids) < 0.01
    hard = docs.where("doc_id <> 5")
    known = {i: x + end for i, x in enumerate(whole("word_bpe_49k.json", TEXTS)) if i != 5}
    assert check_pieces(packing.pack(hard).collect(), known) < 0.02
    n = packing.pack(docs).agg(F.sum("length")).first()[0]
    assert n == sum(len(x) // 4 for x in known.values()) + 2 * len(
        whole("word_bpe_49k.json", [TEXTS[5]])[0]) // 4 + 2 + len(
        whole("word_bpe_49k.json", ["no id here at all today"])[0]) // 4 + 1
    assert packing.packed_pieces(none).count() == 0


def test_sequences_are_put_together(real):
    pieces = packing.pack(real)
    rows = packing.sequences(pieces).collect()
    assert all(r["n_tokens"] <= r["padded"] and len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    assert all(r["padded"] == 2048 or r["padded"] == r["n_tokens"] for r in rows)


def test_op_queries_agree_with_brute_force(real):
    texts = dict(real.select("doc_id", "text").collect())
    end = np.array([0], "<u4").tobytes()
    ids = [x + end for x in whole("byte_bpe_50k.json", [texts[d] for d in sorted(texts)])]
    rows = sorted(simple8b.written_and_read(real).collect())
    starts = np.cumsum([0] + [len(x) // 4 for x in ids]).tolist()
    assert [tuple(r) for r in rows] == [
        (d, s, len(x) // 4, zlib.crc32(x)) for d, s, x in zip(sorted(texts), starts, ids)]
