"""Repaired conversations against every sequence of edits, tried out."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import types as T

from tracklake.llm.conversation_repair import damaged, repair

SCHEMA = T.StructType([T.StructField(c, k) for c, k in (("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()), ("n", T.LongType()), ("audit", T.StringType()))])
BLANK = " \t\n\x0b\x0c\r"


def in_order(rows):
    """Rows (turn, role, text, n) as they stand, nulls first."""
    shown = [(t is not None, t, " " if r is None else r, " " if x is None else x, n) for t, r, x, n in rows]
    return [(t, r, x) for _, t, r, x, n in sorted(shown, key=lambda v: (v[0], v[1] or 0, v[2].encode(), v[3].encode())) for _ in range(n)]


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        bare = text.strip(BLANK)
        out.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def tried(rows):
    """The least (cost, audit, lines) of all sequences of edits with at most two insertions in one place."""
    wrong, best = faults(rows), None
    for edits in itertools.product("DKR", repeat=len(rows)):
        if any(e != "D" and w in ("blank", "duplicate") for e, w in zip(edits, wrong, strict=True)):
            continue
        for places in itertools.product(range(3), repeat=len(rows) + 1):
            cost, audit, state, lines, bad = 0, "", "", [], False
            for k, n in enumerate(places):
                for _ in range(n):
                    state += "a" if state.endswith("u") else "u"
                    lines.append({"u": "user:", "a": "assistant:"}[state[-1]])
                    cost, audit = cost + 2, audit + "I"
                if k == len(rows):
                    break
                _, role, text = rows[k]
                audit += edits[k]
                if edits[k] == "D":
                    cost += 3
                    continue
                cost += (wrong[k] == "truncated") + 2 * (edits[k] == "R")
                to = role[:1] if edits[k] == "K" else "a" if state.endswith("u") else "u"
                state += to or "?"
                lines.append(f"{role if edits[k] == 'K' else {'u': 'user', 'a': 'assistant'}[to]}:{text}")
            bad = not re.fullmatch("(s?(ua)+)?", state)
            if not bad and (best is None or (cost, audit) < best[:2]):
                best = (cost, audit, lines)
    return best


def expected(rows):
    rows = in_order(rows)
    wrong, turns = faults(rows), {t for t, _, _ in rows if t is not None}
    cost, audit, lines = tried(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(rows))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return (gaps, wrong.count("blank"), wrong.count("duplicate"), wrong.count("truncated"), illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def got(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.mark.parametrize("block_rows", [1, 2, 1024])
def test_every_sequence_of_edits(spark, block_rows):
    rng = random.Random(11)
    convs = {}
    for c in range(120):
        convs[c] = [
            (rng.choice([None, *range(6)]), rng.choice(["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(["A.", "b", "c!", " \n", "", "d? ", "é", None]), rng.choice([0, 1, 1, 1, 2]))
            for _ in range(rng.randrange(1, 4))
        ]
        while sum(n for *_, n in convs[c]) > 4:
            convs[c].pop()
    convs[None] = [(0, "user", "hi.", 1), (0, "user", "hi.", 1), (2, "assistant", "ho", 1)]
    convs[777] = [(2**63 - 1, "user", "a.", 1), (-(2**63), "assistant", "b.", 1)]
    rows = [(c, *r, "x") for c, found in convs.items() for r in found]
    rng.shuffle(rows)
    out = got(repair(spark.createDataFrame(rows, SCHEMA), block_rows=block_rows))
    assert set(out) == set(convs)
    for c, found in convs.items():
        want = expected(found)
        assert out[c] == (2**63 - 1, *want[1:]) if c == 777 else out[c] == want, (c, found)


def test_long_conversation_in_blocks(spark):
    """One conversation over many blocks and tasks gives what it gives in one block."""
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice([f"t{t}.", "same.", "", f"cut {t}"]), 1, None) for t in range(3000)]
    rows += [(7, t, "user", "same.", 400, None) for t in range(3000, 3003)] + [(8, 0, "user", "a.", 1, None), (8, 1, "assistant", "b.", 1, None), (9, 3, "user", "gone", 0, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(8).cache()
    parts, whole = got(repair(df, block_rows=50)), got(repair(df, block_rows=100_000))
    assert parts == whole
    assert parts[9] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert parts[8][5:7] == (0, "KK") and len(parts[7][6].replace("I", "")) == 4200


def test_damage(spark):
    rows = [(c, t, r, x, None, None) for c in range(30) for t, r, x in ((0, "system", "Be. Good!"), (1, "assistant", None), (None, None, "a?b"))]
    out = {(r.conv_id, r.turn): (r.role, r.text, r.n) for r in damaged(spark.createDataFrame(rows, SCHEMA)).collect()}
    kinds = set()
    for c, t, role, text, *_ in rows:
        role, text = role or " ", text or " "
        kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
        kinds.add(kind)
        want = (("user" if kind == 4 else role), "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text, {0: 0, 3: 2}.get(kind, 1))
        assert out[c, t] == want
    assert kinds >= {0, 1, 2, 3, 4}


def test_no_rows(spark):
    assert got(repair(damaged(spark.createDataFrame([], SCHEMA)))) == {}
