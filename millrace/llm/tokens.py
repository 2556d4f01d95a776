"""Byte-level BPE with the tokenizers library over Arrow batches: ids, offsets, decoding.

A text falls into chunks at its white space, and where a full stop or comma ends a word. No rule of
the three vocabularies looks across such a border, so the distinct chunks of a batch, found by a hash and compared byte by byte, are looked up
in a dictionary of bounded size or given to the library, and the ids of a text are those of its chunks, end to end.

Defined results: null text counts as empty and has no ids; repeated rows give repeated results; an
empty table gives an empty table; other columns, whatever their names, are neither read nor kept
unless listed in ``carry``, and a result replaces one of its name; nulls in them pass through.
"""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm.common import apart, fresh, over_slices, text_bytes
from millrace.llm.scan import POWERS, SPACES, byte_set, mixed

# Characters with the Unicode property White_Space: fixed values.
WHITE = "\x09-\x0d\x20\x85\xa0  -     　"
WHITE_WIDE = [chr(c) for c in (
    0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
ASCII_LETTERS = byte_set((65, 90), (97, 122))
BYTES = np.random.default_rng(13).integers(1, 1 << 63, 256, dtype=np.uint64)
FIRST_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
# A run of Latin letters ends a chunk where white space, a full stop or a comma follows it.
LETTERS = "A-Za-zÀ-ÖØ-öø-ɏ"
PLAIN = f"[{LETTERS}]+(?=[{WHITE}.,]|\\Z)"
CHUNK = re.compile(f" ?{PLAIN}| ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
WORD = re.compile(f"{PLAIN}|[^{WHITE}]+")
# Chunks kept by one worker, and the longest chunk that is kept.
CACHE_CHUNKS = 300_000
CACHE_CHARS = 48
# Text encoded at a time.
ENCODE_BYTES = 2_000_000
# Words given to the library as one text.
GROUP = 512
# What a word-level vocabulary adds to the last piece of a word.
WORD_END = "</w>"
NO_BYTES = b""


@lru_cache(maxsize=1)
def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Bytes that are visible Latin-1 characters stand for themselves; the others take the characters
    from U+0100 on, in order.
    """
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0x100
    for byte in range(256):
        if byte in seen:
            out[byte] = chr(byte)
        else:
            out[byte], spare = chr(spare), spare + 1
    return out


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their rank, as a rank file lists them."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines if x.strip())}


def tokenizer_from_ranks(path: str, pattern: str):
    """A tokenizers object that merges as the ranks say, within each match of the pattern."""
    from tokenizers import Regex, Tokenizer
    from tokenizers.models import BPE
    from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

    ranks = read_ranks(path)
    shown = byte_characters()
    name = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        for cut in range(1, len(token)):
            if token[:cut] in ranks and token[cut:] in ranks:
                merges.append((name[token[:cut]], name[token[cut:]]))
    model = BPE(vocab={name[t]: r for t, r in ranks.items()}, merges=merges, ignore_merges=True)
    made = Tokenizer(model)
    made.pre_tokenizer = Sequence([
        Split(Regex(pattern), "isolated"), ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


def chunk_starts(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where chunks begin in texts without white space beyond ASCII.

    A word takes one blank before it along; white space before that is a chunk, and so is a last
    white character other than a blank. A full stop or comma after an ASCII letter begins one.
    """
    white, n = SPACES[raw], len(raw)
    begin, inner = np.zeros(n + 1, bool), np.ones(n, bool)
    inner[bounds[:-1][bounds[:-1] < n]] = False
    begin[bounds] = True
    turns = np.flatnonzero(white[1:] != white[:-1]) + 1
    turns = turns[inner[turns]]
    to_word = turns[~white[turns]]
    begin[turns[white[turns]]] = True
    begin[to_word - 1] = True
    begin[to_word[raw[to_word - 1] != 32]] = True
    stops = np.flatnonzero((raw == 46) | (raw == 44))
    stops = stops[inner[stops]]
    begin[stops[ASCII_LETTERS[raw[stops - 1]]]] = True
    return np.flatnonzero(begin[:-1])


def rare_white(raw: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Rows with white space beyond ASCII."""
    hits = []
    for character in WHITE_WIDE:
        code = character.encode()
        at = np.flatnonzero(raw == code[0])
        at = at[at + len(code) <= len(raw)]
        for k in range(1, len(code)):
            at = at[raw[at + k] == code[k]]
        hits.append(at)
    return np.unique(np.searchsorted(bounds, np.concatenate(hits), side="right") - 1)


def equal_chunks(raw: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                 model: np.ndarray) -> np.ndarray:
    """Whether each chunk has the same bytes as the chunk whose number stands in ``model``.

    The first and last eight bytes, read as one number each, are all of a chunk of up to sixteen.
    """
    padded = np.concatenate([raw, np.zeros(8, np.uint8)])
    eight = np.ndarray(len(raw) + 1, "<u8", padded.data, strides=(1,))
    mask = FIRST_BYTES[np.minimum(sizes, 8)]
    head, tail = eight[starts] & mask, eight[np.maximum(starts + sizes - 8, starts)] & mask
    same = (sizes[model] == sizes) & (head[model] == head) & (tail[model] == tail)
    longer = np.flatnonzero(same & (sizes > 16))
    if len(longer):
        n = sizes[longer]
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        alike = raw[np.repeat(starts[longer], n) + at] == raw[np.repeat(starts[model[longer]], n) + at]
        same[longer] = np.logical_and.reduceat(alike, np.cumsum(n) - n)
    return same


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, one ``bytes`` object per text.

    New chunks that are a single Latin word go to the library many at a time, as one text with
    blanks between them; the vocabulary marks where a word begins or ends in the ids. The others
    go one by one.
    """

    def __init__(self, tokenizer, drops_white: bool):
        tokenizer.encode_special_tokens = True
        self.tokenizer, self.known = tokenizer, {}
        self.chunk, self.glue = (WORD, " ") if drops_white else (CHUNK, "")
        self.plain = re.compile(f" ?[{LETTERS}]+" if drops_white else f" [{LETTERS}]+").fullmatch
        self.marks_end = drops_white
        space = byte_characters()[0x20]
        names = tokenizer.get_vocab()
        self.edge = np.zeros(max(names.values(), default=-1) + 1, bool)
        for name, number in names.items():
            self.edge[number] = name.endswith(WORD_END) if drops_white else name.startswith(space)

    def _ids(self, chunks: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        plain = [c for c in chunks if self.plain(c)]
        groups = [plain[i:i + GROUP] for i in range(0, len(plain), GROUP)]
        whole = self.tokenizer.encode_batch_fast(
            [self.glue.join(g) for g in groups], add_special_tokens=False)
        for group, found in zip(groups, whole):
            ids = np.array(found.ids, dtype="<u4")
            cuts = np.flatnonzero(self.edge[ids])
            if len(cuts) != len(group):
                continue
            cuts = np.append(0, cuts + 1) if self.marks_end else np.append(cuts, len(ids))
            raw, cuts = ids.tobytes(), (4 * cuts).tolist()
            out.update((c, raw[a:b]) for c, a, b in zip(group, cuts, cuts[1:]))
        rest = [c for c in chunks if c not in out]
        found = self.tokenizer.encode_batch_fast(rest, add_special_tokens=False)
        out.update((c, np.array(x.ids, dtype="<u4").tobytes()) for c, x in zip(rest, found))
        return out

    def _found(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of distinct chunks, from the dictionary or the library."""
        found = list(map(self.known.get, chunks))
        missing = [i for i, ids in enumerate(found) if ids is None]
        if missing:
            names = [chunks[i].decode() for i in missing]
            made = self._ids(names)
            full = len(self.known) >= CACHE_CHUNKS
            for i, name in zip(missing, names):
                found[i] = ids = made[name]
                if not full and len(name) <= CACHE_CHARS:
                    self.known[chunks[i]] = ids
        return found

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of every text of an Arrow column; null counts as empty."""
        raw, bounds = text_bytes(texts)
        starts = chunk_starts(raw, bounds)
        sizes = np.diff(np.append(starts, len(raw)))
        if len(starts):
            at = np.arange(len(raw)) - np.repeat(starts, sizes)
            h = mixed(np.add.reduceat(BYTES[raw] * POWERS[at & 255], starts) + sizes.astype(np.uint64))
            _, first, kind = np.unique(h, return_index=True, return_inverse=True)
            # Chunks share ids only if their bytes are equal; the others are kinds of their own.
            same = equal_chunks(raw, starts, sizes, first[kind])
            apart = np.flatnonzero(~same)
            kind[apart] = len(first) + np.arange(len(apart))
            first = np.concatenate([first, apart])
            data, begin = raw.tobytes(), starts[first]
            found = self._found(
                [data[a:b] for a, b in zip(begin.tolist(), (begin + sizes[first]).tolist())])
            lengths = np.fromiter(map(len, found), np.int64, len(found)) // 4
            flat, offset = np.frombuffer(NO_BYTES.join(found), "<u4"), np.cumsum(lengths) - lengths
            n = lengths[kind]
            upto = np.concatenate([[0], np.cumsum(n)])
            ids = flat[np.repeat(offset[kind] - upto[:-1], n) + np.arange(upto[-1])].tobytes()
            cuts = (4 * upto[np.searchsorted(starts, bounds)]).tolist()
            out = [ids[a:b] for a, b in zip(cuts, cuts[1:])]
        else:
            out = [NO_BYTES] * len(texts)
        for i in rare_white(raw, bounds).tolist():
            parts = self.chunk.findall(texts[i].as_py())
            ids = dict(zip(set(parts), self._found([c.encode() for c in set(parts)])))
            out[i] = NO_BYTES.join(map(ids.__getitem__, parts))
        return out


@lru_cache(maxsize=4)
def file_encoder(path: str, drops_white: bool) -> Encoder:
    """Encoder of a tokenizers file; ``drops_white`` if its rules ignore white space."""
    from tokenizers import Tokenizer
    return Encoder(Tokenizer.from_file(path), drops_white)


@lru_cache(maxsize=4)
def rank_encoder(path: str, pattern: str) -> Encoder:
    return Encoder(tokenizer_from_ranks(path, pattern), False)


@lru_cache(maxsize=4)
def token_table(path: str) -> tuple[list[bytes], np.ndarray]:
    """Bytes of each id, and their number."""
    ranks = read_ranks(path)
    out = [NO_BYTES] * (max(ranks.values(), default=-1) + 1)
    for token, rank in ranks.items():
        out[rank] = token
    return out, np.array([len(t) for t in out], np.int64)


def offsets(ids: np.ndarray, path: str, raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each id in characters. A character that several ids share belongs to each."""
    ends = np.cumsum(token_table(path)[1][ids])
    starts = ends - token_table(path)[1][ids]
    leads = (np.frombuffer(raw, np.uint8) & 0xC0) != 0x80
    upto = np.concatenate([[0], np.cumsum(leads)])
    first = upto[np.minimum(starts + 1, len(raw))] - 1
    return np.maximum(first, 0), upto[ends]


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN,
           carry: tuple[str, ...] = ("doc_id",), with_offsets: bool = False) -> DataFrame:
    """``ids`` (binary, little-endian unsigned 32-bit) of every whole text, by a rank file.

    With ``with_offsets`` also ``starts`` and ``ends``, the character range of every id.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    source = docs.select(
        F.col("text").alias(fresh("text")), *apart(carry, "ids", "starts", "ends"))
    kept = [f for f in source.schema.fields[1:]]
    fields = [*kept, T.StructField("ids", T.BinaryType())]
    if with_offsets:
        fields += [T.StructField(n, T.ArrayType(T.IntegerType())) for n in ("starts", "ends")]

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = rank_encoder(path, pattern).encode(batch.column(0))
        columns = [*batch.columns[1:], pa.array(ids, pa.binary())]
        if with_offsets:
            raws = [(t or "").encode() for t in batch.column(0).to_pylist()]
            pairs = [offsets(np.frombuffer(i, "<u4"), path, r) for i, r in zip(ids, raws)]
            columns += [pa.array([p[k].tolist() for p in pairs], pa.list_(pa.int32())) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(over_slices(work, most=ENCODE_BYTES), T.StructType(fields))


def decode(encoded: DataFrame, path: str | None = None, carry: tuple[str, ...] = ("doc_id",),
           with_text: bool = False) -> DataFrame:
    """``decoded`` (binary) of every row's ``ids``, and with ``with_text`` also ``text``.

    Bytes are joined before they are read as UTF-8, so a character that ids split comes back
    whole; bytes that form no character become U+FFFD in ``text`` and stay as they are in
    ``decoded``. Null ids count as none.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    source = encoded.select(
        F.col("ids").alias("ids"), *apart(carry, "ids", "decoded", "text"))
    fields = [*source.schema.fields[1:], T.StructField("ids", T.BinaryType()),
              T.StructField("decoded", T.BinaryType())]
    if with_text:
        fields.append(T.StructField("text", T.StringType()))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        get = token_table(path)[0].__getitem__
        raw = [NO_BYTES.join(map(get, np.frombuffer(i or NO_BYTES, "<u4").tolist()))
               for i in batch.column(0).to_pylist()]
        columns = [*batch.columns[1:], batch.column(0), pa.array(raw, pa.binary())]
        if with_text:
            columns.append(pa.array([r.decode("utf-8", "replace") for r in raw], pa.string()))
        return pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return source.mapInArrow(over_slices(work), T.StructType(fields))


def round_trip(docs: DataFrame) -> DataFrame:
    """Query op5: digests of ids and decoded bytes of every document."""
    both = decode(encode(docs))
    return both.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
