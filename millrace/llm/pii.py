"""Personal data by candidates and boosted trees.

Base patterns find what has an exact form: emails, IP addresses, card numbers with a valid check
digit, international phone numbers. They always stay. Two generators propose more, overlapping
freely: any number of seven digits or more with blanks, dots, brackets or dashes inside, and
address-like strings including spelled-out ones such as ``name [at] host [dot] org``. Boosted trees score a
candidate from its format and its surroundings; they learn from the candidates of all documents. What the base patterns confirm is surely personal, the rest is unknown, not clean. So the
trees see a candidate without what only the base form has (``MASKED``: no country prefix, spelled-out
addresses as plain ones): a national number looks like an international one, and only looks and
surroundings that confirmed spans do not share speak against it. Held-out candidates give the share
of personal ones that the base confirms, as the mean confirmed share at the scores of confirmed ones
(Elkan and Noto); each kind gets the lowest score at which the confirmed ones are ``PRECISION`` of that
share of what reaches it; a kind whose held-out candidates are all confirmed takes every candidate, if
they are enough to tell. Candidates that reach it and overlap no base span are added, a
long number only if it passes the check digit.

All of it is built-in functions on arrays within a row, so no text moves; the trees become one
expression. Work is linear in a text: running places and reaches are taken in blocks, overlaps are
found by sorting, and no match walks through the text. The base patterns are written without backtracking over repeated groups, so long runs
cost linear time and no stack.

Defined results: null text counts as empty and has no spans; repeated rows get equal spans; without
candidates of both sorts nothing is added; an empty table gives no rows. Columns in
``carry`` pass through, but for those named like a result.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import apart, fresh, staged

KINDS = ("email", "ip", "card", "phone")
# The base patterns, in possessive form. A match may begin where the last one ended.
LOCAL = "[A-Za-z0-9._%+-]"
HOST = "[A-Za-z0-9-]"
PATTERNS = {
    "email": rf"(?:(?<!{LOCAL})|\G){LOCAL}++@{HOST}++(?:\.{HOST}++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    "near_number": r"[+(]{0,2}+[0-9](?:[\x20().-]{0,3}+[0-9])*+",
    "near_address": (
        rf"(?:(?<!{LOCAL})|\G){LOCAL}++\x20?(?:@|[\[(]at[\])])\x20?{HOST}++"
        rf"(?:(?:\.|\x20?[\[(]dot[\])]\x20?){HOST}++)++"),
}
# What a text must hold for a pattern to be tried at all.
NEEDS = {
    "email": "contains(t, '@')", "ip": "rlike(t, '[0-9]')", "card": "rlike(t, '[0-9][ -]?[0-9]')",
    "phone": "contains(t, '+')", "near_number": "rlike(t, '[0-9]')",
    "near_address": "rlike(t, '@|[\\\\[(]at[\\\\])]')",
}
LUHN = (
    "aggregate(sequence(1, length(d)), 0, (s, i) -> s + "
    "if(i % 2 = 1, int(substr(d, -i, 1)), "
    "int(substr(d, -i, 1)) * 2 - if(int(substr(d, -i, 1)) > 4, 9, 0))) % 10 = 0")
DIGITS = "length(regexp_replace(m, '[^0-9]', ''))"
VALID = {
    "email": "true",
    "ip": "forall(transform(split(m, '[.]'), x -> ltrim('0', x)), "
          "x -> length(x) < 4 and coalesce(int(nullif(x, '')), 0) <= 255)",
    "card": f"{DIGITS} between 14 and 19 and "
            f"transform(array(regexp_replace(m, '[^0-9]', '')), d -> {LUHN})[0]",
    "phone": f"{DIGITS} between 10 and 15",
    "near_number": f"{DIGITS} >= 7",
    "near_address": "true",
}
# What the trees see of a match ``raw``: an address spelled plainly, a number without country prefix.
MASKED = {
    "near_number": "regexp_replace(raw, "
                   "'^[(]?[+]+(?:[0-9]{1,3}(?:[)]?[\\\\x20.-]+|(?=[(])))?', '')",
    "near_address": "regexp_replace(regexp_replace(raw, "
                    "'\\\\x20?(?:@|[\\\\[(]at[\\\\])])\\\\x20?', '@'), '\\\\x20?[\\\\[(]dot[\\\\])]\\\\x20?', '.')",
}
FEATURES = {
    "chars": "length(m)", "digits": DIGITS,
    "letters": "length(regexp_replace(m, '[^A-Za-z]', ''))",
    "dots": "length(regexp_replace(m, '[^.]', ''))",
    "dashes": "length(regexp_replace(m, '[^-]', ''))",
    "blanks": "length(regexp_replace(m, '[^ ]', ''))",
    "brackets": "length(regexp_replace(m, '[^()\\\\[\\\\]]', ''))",
    "at": "int(contains(m, '@'))",
    "groups": "size(filter(split(m, '[^0-9]+'), x -> x <> ''))",
    "longest": "coalesce(array_max(transform(split(m, '[^0-9]+'), x -> length(x))), 0)",
    "word_before": "int(rlike(before, '[A-Za-z0-9_]$'))",
    "word_after": "int(rlike(after, '^[A-Za-z0-9_]'))",
    "lines_around": "length(regexp_replace(before || after, '[^\\\\n]', ''))",
    "digits_around": "length(regexp_replace(before || after, '[^0-9]', ''))",
    "marks_around": "length(regexp_replace(before || after, '[A-Za-z0-9 \\\\n]', ''))",
}
# What a candidate must hold to be added: a long number passes the check digit.
ADDED = {
    "near_number": f"{DIGITS} < 13 or {DIGITS} <= 19 and "
                   f"transform(array(regexp_replace(m, '[^0-9]', '')), d -> {LUHN})[0]",
    "near_address": "true",
}
CONTEXT = 24
# Steps of a running result that are taken at a time, and characters of a text cut at a time.
BLOCK = 256
CUT = 512
ROUNDS = 12
DEPTH = 3
PRECISION = 0.98
# A tenth of random digits pass the check digit; a smaller confirmed share than twice that is chance.
LEAST_CONFIRMED = 0.2
# A threshold below any score.
EVERY = -1e9


def _pieces(name: str) -> Column:
    """The text cut before each match, with the match's end marked; null if nothing can match."""
    pattern = PATTERNS[name].replace("\\", "\\\\")
    return F.expr(
        f"case when {NEEDS[name]} then split(regexp_replace(t, '{pattern}', "
        f"'\\u0001$0\\u0002'), '\\u0001') end")


def let(name: str, value: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def running(values: str, zero: str, merge: str, inclusive: bool) -> str:
    """Running results over an array: ``merge`` joins ``s`` and ``n``. Exclusive ones start at ``zero``.

    An array cannot be extended in place, so steps are taken within blocks, and the results of whole
    blocks are carried over: n values cost n times half a block, not n squared.
    """
    def steps(block: str, first: str) -> str:
        joined = merge.replace("$s", "element_at(done, -1)").replace("$n", "n")
        return f"aggregate({block}, array({first}), (done, n) -> concat(done, array({joined})))"

    joined = merge.replace("$s", "s").replace("$n", "n")
    cut = f"transform(sequence(0, greatest(size(vs) - 1, 0) div {BLOCK}), k -> slice(vs, k * {BLOCK} + 1, {BLOCK}))"
    whole = f"transform(blocks, b -> aggregate(b, {zero}, (s, n) -> {joined}))"
    inner = (f"flatten(transform(blocks, (b, k) -> slice({steps('b', 'get(bases, k)')}, "
             f"{2 if inclusive else 1}, size(b))))")
    return let("vs", values, let("blocks", cut, let("bases", steps(whole, zero), inner)))


def _spans(name: str, keep_text: bool) -> Column:
    """Valid matches in text order: kind and place, or with ``keep_text`` place, match, surroundings.

    Surroundings come from the ends of the pieces around a match: every piece but the first holds a
    match, so ``CONTEXT`` pieces on either side are enough.
    """
    body = "'start', y.b, 'end', y.b + char_length(y.m)"
    if keep_text:
        body += (
            f", 'm', y.m, 'before', right(array_join(slice(tails, greatest(y.i - {CONTEXT} + 2, 1), "
            f"least(y.i + 1, {CONTEXT})), ''), {CONTEXT}), 'after', left(concat(y.rest, "
            f"array_join(slice(heads, y.i + 3, {CONTEXT}), '')), {CONTEXT})")
    else:
        body = f"'kind', '{name}', 'rank', {KINDS.index(name)}, " + body
    lengths = "transform(p, (x, i) -> char_length(x) - if(i = 0, 0, 1))"
    found = (
        "transform(slice(p, 2, size(p) - 1), (x, i) -> named_struct("
        "'m', substring_index(x, '\\u0002', 1), 'b', get(starts, i + 1), 'i', i"
        + (f", 'rest', left(substring_index(x, '\\u0002', -1), {CONTEXT})" if keep_text else "") + "))")
    valid = f"filter({found}, y -> {let('m', 'y.m', VALID[name])})"
    out = f"transform({valid}, y -> named_struct({body}))"
    if keep_text:
        plain = "replace(x, '\\u0002', '')"
        out = let("heads", f"transform(p, x -> left({plain}, {CONTEXT}))",
                  let("tails", f"transform(p, x -> right({plain}, {CONTEXT}))", out))
    out = let("starts", running(lengths, "0", "$s + $n", inclusive=False), out)
    return F.expr(let("p", f"p_{name}", f"case when size(p) > 1 then {out} end"))


def overlapping(base: str, spans: str) -> str:
    """For each of some spans that follow one another, whether it overlaps a base span.

    Starts of base spans and ends of the others are sorted together; the furthest end of the base
    spans so far lies beyond the start of a span if one of them overlaps it.
    """
    events = (
        f"sort_array(concat(transform({spans}, (x, i) -> named_struct('at', x.end, 'i', i, 'to', 0)), "
        f"transform({base}, x -> named_struct('at', x.start, 'i', {1 << 30}, 'to', x.end))))")
    reach = running("transform(es, e -> e.to)", "0", "greatest($s, $n)", inclusive=True)
    hits = let("reach", reach, (
        f"filter(transform(es, (e, j) -> if(e.i < {1 << 30}, get(reach, j), -1)), r -> r >= 0)"))
    return let("es", events, hits)


def in_order(spans: str) -> str:
    """Spans by start, then kind, then end, each once."""
    keyed = f"sort_array(transform({spans}, x -> struct(x.start, x.rank, x.end, x.kind)))"
    once = "filter(ks, (x, i) -> i = 0 or x <> get(ks, i - 1))"
    return let("ks", keyed, (
        f"transform({once}, x -> named_struct('kind', x.kind, 'rank', x.rank, 'start', x.start, "
        "'end', x.end))"))


def with_candidates(df: DataFrame, carry: tuple[str, ...]) -> DataFrame:
    """Carried columns, ``base`` spans, and ``candidates``: place, match, surroundings, label.

    A candidate's label is 1 if it overlaps a base span. Marks that would clash with control
    characters of the text are avoided by changing those first; lengths stay the same.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    marked = F.contains(text, F.lit("\x01")) | F.contains(text, F.lit("\x02"))
    df = df.select(*carry, F.when(marked, F.translate(text, "\x01\x02", "\x03\x03")).otherwise(text).alias("t"))
    df = df.select(*carry, *[_pieces(n).alias(f"p_{n}") for n in PATTERNS])
    df = df.select(*carry, *[_spans(n, n not in KINDS).alias(f"c_{n}") for n in PATTERNS])
    base = in_order("concat(" + ", ".join(
        f"coalesce(c_{n}, cast(array() as array<struct<kind string, rank int, start int, end int>>))"
        for n in KINDS) + ")")
    df = df.select(*carry, F.expr(base).alias("base"), "c_near_number", "c_near_address")
    features = ", ".join(f"'{k}', double({v})" for k, v in FEATURES.items())
    kind_number = let("m", "raw", (
        f"case when length(m) - length(replace(m, '.', '')) = 3 and {DIGITS} <= 12 then 'ip' "
        f"when {DIGITS} >= 13 then 'card' else 'phone' end"))

    def scored(name: str, kind: str) -> str:
        one = let("raw", "c.m", let("m", MASKED[name], let("before", "c.before", let("after", "c.after", (
            f"named_struct('kind', {kind}, 'start', c.start, 'end', c.end, "
            f"'label', int(get(reach_of, i) > c.start), 'valid', {let('m', 'raw', ADDED[name])}, "
            f"'f', named_struct({features}))")))))
        return let(
            "cs", f"coalesce(c_{name}, cast(array() as array<struct<start int, end int, m string, "
            "before string, after string>>))",
            let("reach_of", overlapping("base", "cs"), f"transform(cs, (c, i) -> {one})"))

    return df.withColumn("candidates", F.expr(
        f"concat({scored('near_number', kind_number)}, {scored('near_address', repr('email'))})"
    )).drop("c_near_number", "c_near_address")


class Trees:
    """Boosted trees as one expression over a candidate's features, and a threshold per kind."""

    def __init__(self, margin: str | None, thresholds: dict[str, float]):
        self.margin, self.thresholds = margin, thresholds


def _tree(node, names: list[str]) -> str:
    if not node.getClass().getSimpleName().startswith("Internal"):
        return f"{node.prediction()!r}D"
    split = node.split()
    left, right = _tree(node.leftChild(), names), _tree(node.rightChild(), names)
    return f"if(c.f.{names[split.featureIndex()]} <= {split.threshold()!r}D, {left}, {right})"


def as_expression(model: GBTClassificationModel, names: list[str]) -> str:
    """The trees' weighted sum as SQL over the struct ``c.f``."""
    return " + ".join(
        f"{weight!r}D * {_tree(tree._call_java('rootNode'), names)}"
        for weight, tree in zip(model.treeWeights, model.trees))


def fit(docs: DataFrame, rounds: int = ROUNDS, precision: float = PRECISION) -> Trees:
    """Fit trees and thresholds on the candidates of all documents."""
    names = list(FEATURES)
    rows = staged(
        with_candidates(docs.select("doc_id", "text"), ("doc_id",)).select("doc_id", F.inline("candidates"))
        .select("kind", "label", "f.*", (F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(10)) < 7)
                .alias("learn")), "candidates")
    sorts = {r["label"] for r in rows.where("learn").groupBy("label").count().collect()}
    if sorts != {0, 1}:
        return Trees(None, {})
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    learner = GBTClassifier(maxIter=rounds, maxDepth=DEPTH, seed=3, cacheNodeIds=False)
    margin = as_expression(learner.fit(vectors.transform(rows.where("learn"))), names)
    held = rows.where("not learn").withColumn("c", F.struct(F.struct(*names).alias("f")))
    tally = held.groupBy("kind", F.round(F.expr(margin), 2).alias("score")).agg(
        F.sum("label").alias("right"), F.count("*").alias("n")).collect()
    thresholds = {}
    for kind in KINDS:
        scores = sorted((r for r in tally if r["kind"] == kind), key=lambda r: -r["score"])
        confirmed = sum(r["right"] for r in scores)
        if not confirmed:
            continue
        share = max(LEAST_CONFIRMED, sum(r["right"] ** 2 / r["n"] for r in scores) / confirmed)
        right = n = 0
        for row in scores:
            right, n = right + row["right"], n + row["n"]
            if right >= precision * share * n:
                thresholds[kind] = row["score"]
        if right == n and n * (1 - precision) >= 1:  # enough of them, and the base confirms every one
            thresholds[kind] = EVERY
    return Trees(margin, thresholds)


def find(docs: DataFrame, trees: Trees, carry: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """Carried columns, ``base`` and ``spans``: kind, rank, start, end (code points, end exclusive)
    of base spans, and of those with the added ones, by start, then kind."""
    kept = fresh("carry")
    carry = apart(carry, "base", "spans")
    df = with_candidates(docs.select("text", F.struct(*carry).alias(kept)), (kept,))
    added = "cast(array() as array<struct<kind string, rank int, start int, end int>>)"
    if trees.margin and trees.thresholds:
        least = "case c.kind " + " ".join(
            f"when '{k}' then {v!r}D" for k, v in trees.thresholds.items()) + " end"
        rank = "case c.kind " + " ".join(f"when '{k}' then {i}" for i, k in enumerate(KINDS)) + " end"
        added = (
            f"transform(filter(candidates, c -> c.label = 0 and c.valid and "
            f"round({trees.margin}, 2) >= {least}), "
            f"c -> named_struct('kind', c.kind, 'rank', {rank}, 'start', c.start, 'end', c.end))")
    every = F.expr(in_order(f"concat(base, {added})"))
    return df.select(*[F.col(f"{kept}.`{c}`") for c in carry], "base", every.alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.expr(f"array_join(transform({spans}, x -> concat(x.kind, ':', x.start, ':', x.end)), ',')")


def redacted(text: str, spans: str) -> Column:
    """The text with each span, joined with those it overlaps, replaced by its kind in brackets.

    The text is cut into short stretches once; what lies between two spans is taken from those it
    touches, so no span costs a walk through the whole text.
    """
    chunk = (
        f"concat(substr(get(cut, a div {CUT}), a % {CUT} + 1, e - a), "
        f"if(a div {CUT} = e div {CUT}, '', concat("
        f"array_join(slice(cut, a div {CUT} + 2, e div {CUT} - a div {CUT} - 1), ''), "
        f"coalesce(substr(get(cut, e div {CUT}), 1, e % {CUT}), ''))))")

    def between(start: str, end: str) -> str:
        return let("a", start, let("e", end, f"if(a >= e, '', {chunk})"))

    ends = let("sp", spans, running("transform(sp, x -> x.end)", "0", "greatest($s, $n)", inclusive=True))
    # A group begins where no span before reaches; it ends where the spans before the next one end.
    firsts = (
        f"filter(transform({spans}, (x, i) -> if(i = 0 or x.start >= get(ends, i - 1), i, -1)), "
        "i -> i >= 0)")
    parts = (
        f"transform(firsts, (f, j) -> concat("
        f"{between('if(f = 0, 0, get(ends, f - 1))', 'get(sp, f).start')}, "
        f"'[', upper(get(sp, f).kind), ']'))")
    whole = let("sp", spans, let("ends", ends, let("firsts", firsts, let(
        "cut", f"regexp_extract_all({text}, '(?s).{{1,{CUT}}}', 0)",
        f"concat(array_join({parts}, ''), "
        f"{between('element_at(ends, -1)', f'char_length({text})')})"))))
    return F.expr(f"case when size({spans}) = 0 then {text} else {whole} end")


def personal_data(docs: DataFrame) -> DataFrame:
    """Query op2: base and added spans of every document."""
    found = find(docs, fit(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(listed("base").cast("binary"), 256).alias("base_sha256"),
        listed("spans").alias("spans"))
