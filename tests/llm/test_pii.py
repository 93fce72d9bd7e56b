"""Fixed patterns against the plain expressions, and identifiers that only their contexts tell."""

import hashlib
import random
import re
import time

from pyspark.sql import types as T

from tracklake.llm.pii import find, fixed_spans
from tracklake.llm.queries import QUERIES

SCHEMA = T.StructType([T.StructField(c, k) for c, k in (("doc_id", T.LongType()), ("text", T.StringType()), ("row", T.StringType()), ("slots", T.StringType()), ("kind", T.StringType()))])
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    d = [int(c) for c in digits][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0


def plain(text):
    out = []
    for order, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fits = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False,
                "card": 12 <= len(digits) <= 19 and luhn(digits),
                "phone": 9 <= len(digits) <= 15,
            }
            if fits[kind]:
                out.append((m.start(), order, m.end(), kind))
    return [(s, e, k) for s, _, e, k in sorted(out)]


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def made(spark, rows):
    return spark.createDataFrame([(i, t, "a", "b", "c") for i, t in rows], SCHEMA)


def test_fixed_patterns_are_the_plain_ones():
    rng = random.Random(2)
    for k in range(30_000):
        letters = ["a1.@-", "12. -", "+1234 ()-.", "ab@.é\n 19", "0123456789 -", "@.a+%_ 25"][k % 6]
        text = "".join(rng.choice(letters) for _ in range(rng.randrange(40)))
        assert fixed_spans(text) == plain(text), text
    for text in ("4111 1111 1111 1111", "x 255.255.255.255 256.1.1.1 001.002.003.004", "+1 (212) 555-0100 +44 20 7946 0958", "a@b.c@d.e @a.b@c.d", "1.2.3.4.5.6.7.8"):
        assert fixed_spans(text) == plain(text) and fixed_spans(text)


def test_long_runs_take_linear_time():
    n = 400_000
    began = time.time()
    for text in ("a" * n, "1" * n, "1 " * n, "a@" * n, "1." * n, "+1" + " " * n, "a at " * (n // 4), "@" * n, "::" * n, "(at)" * (n // 4), " " * n, "1.1.1.1 " * (n // 8), "a" * n + "1"):
        fixed_spans(text)
        from tracklake.llm.pii import slots

        slots(text, fixed_spans(text))
    assert time.time() - began < 60


def corpus():
    rng = random.Random(7)
    word = lambda: "".join(rng.choice("etaoinshr") for _ in range(rng.randrange(3, 9)))
    some = lambda n: " ".join(word() for _ in range(n))
    rows, unseen = [], {}
    for k in range(12):
        rows += [(f"{some(6)} please write to u{k}@mail{k}.example.org any day {some(5)}"), (f"{some(3)} you may call me at +1 (212) 555-0{k:03d} please {some(4)}")]
        rows += [f"{some(5)} page {rng.randrange(1000)} {some(2)} in room {rng.randrange(10**8, 10**9)} {some(2)}", f"{some(4)} the host 10.0.{k}.{k} was up {some(3)}"]
    for text, kind, shown in [
        ("{} please write to {} any day", "email", "jane.doe [at] corp [dot] example"),
        ("{} please write to {} any day", "email", "bob at corp dot example dot org"),
        ("{} you may call me at {} please", "phone", "(212) 555 0199"),
        ("{} the host {} was up", "ip", "2001:db8:0:1:1:1:1:1"),
    ]:
        text = text.format(some(4), shown)
        at = text.index(shown)
        unseen[len(rows)] = f"{kind}:{at}:{at + len(shown)}"
        rows.append(text)
    rows.append(f"{some(2)} ticket 212-555-0199 {some(2)}")  # the same number as one that its context told
    unseen[len(rows) - 1] = "phone:" + f"{rows[-1].index('212')}:{rows[-1].index('212') + 12}"
    return list(enumerate(rows)), unseen


def test_contexts_tell_unseen_identifiers(spark):
    rows, unseen = corpus()
    for r in find(made(spark, rows)).collect():
        want = [s for s in [joined(plain(rows[r.doc_id][1])), unseen.get(r.doc_id)] if s]
        assert r.spans == ",".join(want), (rows[r.doc_id], r.spans)
        assert r.n_added == (r.doc_id in unseen)


def test_odd_rows(spark):
    text = "a@b.cd 4111111111111111 +1 (212) 555-0100 1.2.3.4"
    rows = [(1, None), (2, ""), (3, "é😀 " + text), (3, text), (None, text), (4, "x" * 20_000 + " " + text), (5, "no data")]
    got = sorted(((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in find(made(spark, rows)).collect()))
    want = []
    for i, t in rows:
        spans = plain(t or "")
        count = [sum(s[2] == k for s in spans) for k in PLAIN]
        want.append((str(i), *count, hashlib.sha256(joined(spans).encode()).hexdigest(), joined(spans)))
    assert got == sorted(want)
    assert find(made(spark, [])).collect() == []


def test_query(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_pii_bootstrap"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        spans = joined(plain(texts[r.doc_id] or ""))
        assert r.base_sha256 == hashlib.sha256(spans.encode()).hexdigest()
        assert set(filter(None, spans.split(","))) <= set(r.spans.split(","))
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [spans.count(k) for k in PLAIN]
