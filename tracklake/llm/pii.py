"""Personal data: fixed patterns, and unseen identifiers by bootstrapped contexts."""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialize, spread

#: Kinds in the order in which they are listed.
KINDS = ("email", "ip", "card", "phone")

#: Rounds of scoring between patterns and instances, seeds that a pattern needs, and the score from which both are trusted.
ROUNDS, LEAST_SEEDS, TRUST = 3, 3, 0.8
#: What a pattern's score is held back by, in instances.
DOUBT = 0.5
#: Letters beside a slot that its contexts are taken from.
LEFT, RIGHT = 64, 32
#: Letters of an instance's name; longer ones go by their digest.
NAME = 100

# Each fixed pattern by its anchor, so that texts without matches are read in linear time.
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_QUAD = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PLUS = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# What may be an identifier though no fixed pattern says so.
_AT = re.compile(r"(?i)\s{0,2}[\[({<]\s?at\s?[\])}>]\s{0,2}|(?<=\S)\sat\s(?=\S)|@")
_NAMED = re.compile(r"(?i)[A-Z0-9-]+(?:(?:\s{0,2}[\[({<]\s?dot\s?[\])}>]\s{0,2}|\sdot\s|\.)[A-Z0-9-]+)*")
_COLONS = re.compile(r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{0,4}(?::[0-9A-Fa-f]{0,4}){3,7}(?![0-9A-Fa-f:])")
_NUMBER = re.compile(r"(?<![0-9])\(?[0-9](?:[\x20()._/-]{0,2}[0-9])++")
_DIGIT, _SPACE = re.compile("[0-9]"), re.compile(r"\s")
_SPOKEN = re.compile(r"(?i)\s{0,2}[\[({<]?\s?\b(at|dot)\b\s?[\])}>]?\s{0,2}")

Span = tuple[int, int]


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def emails(text: str) -> Iterator[Span]:
    end = 0
    for m in _DOMAIN.finditer(text):
        start = m.start()
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < m.start():
            yield start, (end := m.end())


def addresses(text: str) -> Iterator[Span]:
    for m in _QUAD.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            yield m.span()


def cards(text: str) -> Iterator[Span]:
    for m in _DIGITS.finditer(text):
        if 12 <= m.end() - m.start() - m[0].count(" ") - m[0].count("-") <= 19 and luhn(m[0].replace(" ", "").replace("-", "")):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in _PLUS.finditer(text):
        if 9 <= len(_DIGIT.findall(m[0])) <= 15:
            yield m.span()


FIXED = dict(zip(KINDS, (emails, addresses, cards, phones), strict=True))


def fixed_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the fixed patterns by start, then kind as listed."""
    found = [(s, k, e, kind) for k, kind in enumerate(KINDS) for s, e in FIXED[kind](text)]
    return [(s, e, kind) for s, _, e, kind in sorted(found)]


def _spoken_emails(text: str) -> Iterator[Span]:
    """Names and domains with their at and dots in words, or without a dot."""
    for m in _AT.finditer(text):
        d = _NAMED.match(text, m.end())
        start = m.start()
        while start and text[start - 1] in _LOCAL:
            start -= 1
        if d and start < m.start() and (m[0].strip().lower() != "at" or re.search(r"(?i)dot", d[0])):
            yield start, d.end()


def _tokens(text: str) -> Iterator[Span]:
    """Words with a digit."""
    m = _DIGIT.search(text)
    while m:
        start = m.start()
        while start and not text[start - 1].isspace():
            start -= 1
        end = _SPACE.search(text, m.end())
        yield start, (stop := end.start() if end else len(text))
        m = _DIGIT.search(text, stop)


def _possible(text: str) -> Iterator[tuple[int, int, int, list[str]]]:
    """What may be an identifier, as (start, order, end, kinds it may be of)."""
    for s, e in _spoken_emails(text):
        yield s, 0, e, ["email"]
    for m in _COLONS.finditer(text):
        if _DIGIT.search(m[0]) and m.end() - m.start() >= 6:
            yield m.start(), 1, m.end(), ["ip"]
    for m in _NUMBER.finditer(text):
        n = len(_DIGIT.findall(m[0]))
        if 7 <= n <= 19:
            yield m.start() + (m[0][0] == "(" and ")" not in m[0]), 2, m.end(), ["card"] * (n >= 12) + ["phone"] * (n <= 15)
    for s, e in _tokens(text):
        yield s, 3, e, []


def name(kind: str, shown: str) -> str:
    """An identifier however it is written."""
    if kind == "email":
        shown = _SPOKEN.sub(lambda m: "@" if m[1].lower() == "at" else ".", shown).lower()
    elif kind == "ip":
        shown = shown.lower()
    else:
        shown = "".join(_DIGIT.findall(shown))
    return shown if len(shown) <= NAME else hashlib.sha256(shown.encode("utf-8", "surrogatepass")).hexdigest()


def contexts(text: str, start: int, end: int) -> list[str]:
    """Lexical patterns around a slot: the word before it, two words before it, a word on either side."""
    left = _DIGIT.sub("0", text[max(0, start - LEFT) : start].lower()).rstrip("([{<\"'").split()[-2:]
    right = _DIGIT.sub("0", text[end : end + RIGHT].lower()).split()[:1]
    before = left[-1] if left else "^"
    return [f"{before} _", f"{' '.join(left) if len(left) > 1 else '^ ' + before} _", f"{before} _ {right[0] if right else '$'}"]


def slots(text: str, fixed: list[tuple[int, int, str]]) -> list[dict]:
    """Slots for identifiers: the fixed spans, and what lies beside them, leftmost first, none in another."""
    out = [{"start": s, "end": e, "seed": True, "kinds": [kind], "names": [name(kind, text[s:e])], "contexts": contexts(text, s, e)} for s, e, kind in fixed]
    starts, ends, after = [], [], 0
    for s, e, _ in fixed:  # laid together where they meet
        if ends and s < ends[-1]:
            ends[-1] = max(ends[-1], e)
        else:
            starts.append(s)
            ends.append(e)
    for s, _, e, kinds in sorted(_possible(text)):
        k = bisect.bisect_right(ends, s)
        if s >= after and (k == len(starts) or starts[k] >= e):
            out.append({"start": s, "end": e, "seed": False, "kinds": kinds, "names": [name(x, text[s:e]) for x in kinds] or [name("ip", text[s:e])], "contexts": contexts(text, s, e)})
            after = e
    return out


_SLOT = "struct<start:int,end:int,seed:boolean,kinds:array<string>,names:array<string>,contexts:array<string>>"


def _scan(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for value, doc_id in zip(batch.column(1), batch.column(0), strict=True):
                text = value.as_py() or ""
                fixed = fixed_spans(text)
                row = {f"n_{kind}": sum(f[2] == kind for f in fixed) for kind in KINDS}
                rows.append(row | {"doc_id": doc_id.as_py(), "fixed": [{"start": s, "kind": KINDS.index(kind), "end": e} for s, e, kind in fixed], "slots": slots(text, fixed)})
            yield pa.RecordBatch.from_pylist(rows, schema=schema)

    return run


def trusted_names(edges: DataFrame, rounds: int = ROUNDS, least_seeds: int = LEAST_SEEDS, trust: float = TRUST) -> DataFrame:
    """Score patterns and instances by each other, and return instances to trust.

    ``edges``: pattern, name, kind (null: no kind), seed, each pair of pattern
    and name once for each kind.  A pattern's score for a kind is the sum of its
    instances' scores over the number of its names, held back by ``DOUBT``.
    Seeds score 1, others 1 - prod(1 - score) over their patterns of at least
    ``trust``.  Patterns with fewer than ``least_seeds`` seeds of a kind take no
    part.  Returns name, kind, score of what is trusted and is no seed of it.
    """
    seeds = edges.filter("seed").groupBy("pattern", "kind").agg(F.count("*").alias("seeds")).filter(F.col("seeds") >= least_seeds)
    every = edges.groupBy("pattern").agg(F.count_distinct("name").alias("names"))
    patterns = materialize(seeds.join(every, "pattern").select("pattern", "kind", "names"), "patterns")
    graph = materialize(spread(edges.filter("kind is not null"), patterns, ["pattern", "kind"]), "pattern-instances")
    known = None
    for _ in range(rounds):
        scored = graph.withColumn("score", F.col("seed").cast("double"))
        if known is not None:
            scored = spread(graph, known, ["name", "kind"], "left").withColumn("score", F.when(F.col("seed"), 1.0).otherwise(F.coalesce("found", F.lit(0.0))))
        weights = scored.groupBy("pattern", "kind").agg((F.sum("score") / (F.first("names") + DOUBT)).alias("weight")).filter(F.col("weight") >= trust)
        told = spread(graph.filter("not seed"), weights, ["pattern", "kind"])
        known = materialize(told.groupBy("name", "kind").agg((1 - F.exp(F.sum(F.log1p(-F.col("weight"))))).alias("found")), "instances")
    also = edges.filter("seed").select("name", "kind", F.lit(1.0).alias("found"))  # a seed is known wherever it stands and however it is written
    return known.filter(F.col("found") >= trust).unionByName(also).groupBy("name", "kind").agg(F.max("found").alias("score"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """Spans of personal data in every whole text.

    Fixed patterns give emails, ips, cards and phones; they always stay.  Their
    matches are seeds.  The words around seeds make lexical patterns, which
    Spark scores together with the instances in their slots
    (``trusted_names``); instances beyond the fixed patterns (addresses with
    their signs in words or without a dot, addresses with colons, numbers
    without a plus or a checksum) are added where they reach ``TRUST``.
    A slot holds what has a digit or an at; other slots count against patterns.
    Spans that are added touch neither fixed ones nor each other.

    Null and empty texts have no spans; null or repeated ids are rows of their
    own; texts of any length are taken whole; an empty table gives no rows;
    other columns are ignored.  Contexts reach ``LEFT`` and ``RIGHT`` letters.

    Returns ``doc_id``, ``n_email``, ``n_ip``, ``n_card``, ``n_phone`` of the
    fixed patterns, ``base_sha256`` of their spans ``kind:start:end`` (code
    points), by start, then kind, joined by commas, ``spans``, all spans joined
    likewise, and ``n_added``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructField, StructType

    kind = docs.schema[id_col].dataType
    fields = ", ".join(f"n_{k} long" for k in KINDS) + f", fixed array<struct<start:int,kind:int,end:int>>, slots array<{_SLOT}>"
    schema = StructType([StructField("doc_id", kind), *StructType.fromDDL(fields).fields])
    found = docs.select(column(id_col).alias("doc_id"), column(text_col).alias("text")).mapInArrow(_scan(to_arrow_schema(schema)), schema)
    found = materialize(found.withColumn("row", F.monotonically_increasing_id()), "personal-data")
    slot = found.select("row", F.explode("slots").alias("s")).select("row", "s.*")
    each = slot.select("row", "start", "end", "seed", "contexts", F.explode_outer(F.arrays_zip("kinds", "names")).alias("k"))
    each = each.select("row", "start", "end", "seed", "contexts", F.col("k.kinds").alias("kind"), F.col("k.names").alias("name"))
    edges = each.select(F.explode("contexts").alias("pattern"), "name", "kind", "seed").groupBy("pattern", "name", "kind").agg(F.max("seed").alias("seed"))
    trusted = trusted_names(materialize(edges, "contexts"), **how)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")).cast("int") - 1
    added = spread(each.filter("not seed and kind is not null"), trusted, ["name", "kind"])
    added = added.groupBy("row", "start").agg(F.min(F.struct(-F.col("score"), order.alias("kind"), "end")).alias("b"))
    added = added.groupBy("row").agg(F.collect_list(F.struct("start", F.col("b.kind").alias("kind"), F.col("b.end").alias("end"))).alias("more"))
    shown = lambda spans: F.array_join(
        F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1), s["start"], s["end"])), ","
    )
    none = F.expr("cast(array() as array<struct<start:int,kind:int,end:int>>)")
    out = found.drop("slots").join(added, "row", "left").withColumn("more", F.coalesce("more", none))
    return out.select(
        "doc_id", *(f"n_{k}" for k in KINDS), F.sha2(shown(F.col("fixed")), 256).alias("base_sha256"), shown(F.concat("fixed", "more")).alias("spans"),
        F.size("more").cast("long").alias("n_added"),
    )
