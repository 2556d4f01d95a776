import re

import pytest
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"
CLASHING = (
    "score", "shard", "slot", "ids", "tokens", "row", "part", "t", "base", "spans", "set_key", "n",
    "label", "curve", "tie", "b", "guest", "offset", "start", "length", "kept", "component_id",
)
PLAIN = (
    "The river ran past the old mill and the miller counted sacks of grain before the rain came "
    "down from the hills to the quiet town where nobody had slept for three long days at all"
)
LONG = " ".join(f"w{i % 977}x{i % 13}" for i in range(40_000))
TEXTS = [
    None, "", " \t\n ", "one", "two words", PLAIN, PLAIN, PLAIN.replace("quiet", "silent"),
    PLAIN + "\n" + PLAIN.upper(), LONG, "x" * 5_000, "日本語のテキスト😀 é é \x01\x02  wide blank",
    "<|endoftext|> 's 'll 123456 +1 (988) 555-2485 a.b@c.org 10.0.0.255 4041894974608795.",
    "same same same same same same same same",
]


@pytest.fixture(scope="session")
def docs(spark):
    """Hard rows: nulls, empty, very long and repeated texts, a null id, columns with many names."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(5, PLAIN), (None, "no id here at all today")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return frame.withColumns({
        "lang": F.lit(None).cast("string"), "source": F.lit("s"),
        "n_chars": F.char_length("text").cast("long"),
        **{c: F.lit(f"own {c}") for c in CLASHING}})


@pytest.fixture(scope="session")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="session")
def real(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF_DIR}/labels.parquet")


def shingle_set(text, width):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute_components(rows, width):
    """Smallest id reachable over links of similarity 0.8, for rows (id, text)."""
    sets = [shingle_set(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            both = len(a & b)
            if a and b and 100 * both >= 80 * (len(a) + len(b) - both):
                parent[max(root(i), root(j))] = min(root(i), root(j))
    least = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        least[r] = min((x for x in (least.get(r), d) if x is not None), default=None)
    return [(len(sets[i]), least[root(i)]) for i in range(len(rows))]
