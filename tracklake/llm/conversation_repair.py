"""Repair of conversations: the cheapest edits that give a regular order of roles."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import materialize, spread

#: Rows and bytes of a block: what the dynamic programme runs over at one time.
BLOCK_ROWS, BLOCK_BYTES = 1024, 4 << 20
#: Letters of a text that take part in dealing rows out by range.
RANGE_LETTERS = 64

DELETE, REROLE, INSERT, LATE = 3, 2, 2, 1
BLANKS = " \t\n\x0b\x0c\r"

#: The grammar's states: nothing yet, after the system's turn, the user's, the assistant's.  From each but the user's, the user is next.
START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {USER: "user", ASSISTANT: "assistant"}
AFTER = (USER, USER, ASSISTANT, USER)

#: A turn as the dynamic programme sees it: initial of its role, whether it must go, whether it is cut off, and what is written.
Layer = tuple[str, bool, bool, str, str]
Best = tuple[int, str] | None


def least(*found: Best) -> Best:
    return min((b for b in found if b), default=None)


def plus(b: Best, cost: int, edit: str) -> Best:
    return b and (b[0] + cost, b[1] + edit)


def close(v: list[Best]) -> list[Best]:
    """A layer of (cost, audit) by state, closed under insertions.

    Two are enough: a third one comes back to a state at a higher cost.
    """
    user = least(v[USER], *(plus(v[s], INSERT, "I") for s in (START, SYSTEM, ASSISTANT)))
    return [v[START], v[SYSTEM], user, least(v[ASSISTANT], plus(user, INSERT, "I"))]


def step(v: list[Best], layer: Layer) -> list[Best]:
    """The next turn's layer.

    Of equal costs the least audit stays.  Of one state and layer no audit
    begins another of the same cost, so what follows never turns their order.
    """
    initial, gone, late = layer[:3]
    out = [plus(b, DELETE, "D") for b in v]
    if not gone:
        if initial == "s":
            out[SYSTEM] = least(out[SYSTEM], plus(v[START], LATE * late, "K"))
        for state, b in enumerate(v):
            to = AFTER[state]
            kept = plus(b, LATE * late, "K") if initial == ROLES[to][0] else plus(b, LATE * late + REROLE, "R")
            out[to] = least(out[to], kept)
    return close(out)


def written(layers: list[Layer], audit: str, state: int) -> list[str]:
    """The lines that the edits leave, from the state before them."""
    out, k = [], 0
    for edit in audit:
        if edit == "I":
            state = AFTER[state]
            out.append(f"{ROLES[state]}:")
            continue
        initial, _, _, role, text = layers[k]
        k += 1
        if edit == "K":
            state = SYSTEM if initial == "s" else AFTER[state]
            out.append(f"{role}:{text}")
        elif edit == "R":
            state = AFTER[state]
            out.append(f"{ROLES[state]}:{text}")
    return out


def hashed(lines: list[str]) -> str:
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


class Block:
    """Consecutive turns of one conversation, counted and kept for the dynamic programme."""

    def __init__(self, conv, follows: bool, most: int) -> None:
        self.conv, self.follows, self.most = conv, follows, most
        self.layers: list[Layer] = []
        self.bytes = self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first = self.last = None

    def add(self, turn, role: str, text: str, again: bool) -> None:
        shown = text.strip(BLANKS)
        late = bool(shown) and not again and shown[-1] not in ".!?"
        gone = not shown or again
        self.blank += not shown
        self.duplicate += bool(shown) and again
        self.truncated += late
        if self.layers:
            self.illegal += self.layers[-1][0] + role[:1] not in ("su", "ua", "au")
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        self.layers.append((role[:1], gone, late, role, "" if gone else text))
        self.bytes += 0 if gone else len(text)

    @property
    def full(self) -> bool:
        return len(self.layers) >= self.most or self.bytes >= BLOCK_BYTES

    def row(self, part: int, k: int, edge: bool) -> dict:
        found = {
            "conv_id": self.conv, "part": part, "k": k, "edge": edge, "blank": self.blank, "duplicate": self.duplicate, "truncated": self.truncated, "illegal": self.illegal,
            "turns": self.turns, "first": self.first, "last": self.last, "head": self.layers[0][0] if self.layers else None, "tail": self.layers[-1][0] if self.layers else None,
        }
        if not edge:
            v = close([(0, ""), None, None, None])
            for layer in self.layers:
                v = step(v, layer)
            cost, audit = least(v[START], v[ASSISTANT])
            return found | {"cost": cost, "audit": audit, "sha256": hashed(written(self.layers, audit, START))}
        costs, audits = [], []
        for entry in range(4):
            v: list[Best] = [None] * 4
            v[entry] = (0, "")
            for layer in self.layers:
                v = step(v, layer)
            costs += [b and b[0] for b in v]
            audits += [b and b[1] for b in v]
        return found | {"costs": costs, "audits": audits, "layers": [dict(zip(("initial", "gone", "late", "role", "text"), x, strict=True)) for x in self.layers]}


_COUNTS = ("blank", "duplicate", "truncated", "illegal")


#: What a block tells, and, where others belong to its conversation, its tables (from each state to each) and turns.
_BLOCK = ", ".join([
    "part int, k long, edge boolean", *(f"{c} long" for c in (*_COUNTS, "turns", "first", "last")), "head string, tail string, cost long, audit string, sha256 string",
    "costs array<long>, audits array<string>, layers array<struct<initial:string,gone:boolean,late:boolean,role:string,text:string>>",
])


def _of(conv: T.DataType, rest: str) -> T.StructType:
    """A schema of conv_id and the rest."""
    return T.StructType([T.StructField("conv_id", conv), *T.StructType.fromDDL(rest).fields])


class _Rows:
    """Rows gathered into Arrow batches of bounded size."""

    def __init__(self, schema: pa.Schema) -> None:
        self.schema, self.rows, self.bytes = schema, [], 0

    def add(self, row: dict, size: int) -> Iterator[pa.RecordBatch]:
        self.rows.append(row)
        self.bytes += size
        if len(self.rows) >= 1024 or self.bytes >= 4 * BLOCK_BYTES:
            yield from self.rest()

    def rest(self) -> Iterator[pa.RecordBatch]:
        if self.rows:
            yield pa.RecordBatch.from_pylist(self.rows, schema=self.schema)
        self.rows, self.bytes = [], 0


def _blocks(schema: pa.Schema, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, k, out, block = TaskContext.get().partitionId(), 0, _Rows(schema), None
        for batch in batches:
            for row in batch.to_pylist():
                if block is None or row["conv_id"] != block.conv or block.full:
                    if block is not None:
                        same = row["conv_id"] == block.conv
                        yield from out.add(block.row(part, k, edge=k == 0 or same or block.follows), block.bytes)
                        k += 1
                    block = Block(row["conv_id"], block is not None and row["conv_id"] == block.conv, most)
                for i in range(row["n"]):
                    if block.full:
                        yield from out.add(block.row(part, k, edge=True), block.bytes)
                        k += 1
                        block = Block(row["conv_id"], True, most)
                    block.add(row["turn"], row["role"], row["text"], again=i > 0 or not row["is_first"])
        if block is not None:
            yield from out.add(block.row(part, k, edge=True), block.bytes)
        yield from out.rest()

    return run


def _combine(schema: pa.Schema):
    """Blocks in the order of their conversations: the best audit's way through them, and the sums.

    The audits so far of the four states are told apart by a rank, and by what
    follows where one begins another; so they are never held or compared whole.
    """

    def ended(blocks: list[dict], v, ways: list[list[int]], total: dict) -> Iterator[dict]:
        state = min((v[s], s) for s in (START, ASSISTANT) if v[s])[1]
        total["cost"] = v[state][0]
        total["gaps"] = min(total["last"] - total["first"] + 1 - total["turns"], 2**63 - 1) if total["turns"] else 0
        yield {"conv_id": total["conv_id"], "whole": True} | {c: total[c] for c in (*_COUNTS, "cost", "gaps")}
        for (part, k), way in zip(reversed(blocks), reversed(ways), strict=True):
            yield {"conv_id": total["conv_id"], "whole": False, "part": part, "k": k, "entry": way[state], "exit": state}
            state = way[state]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, total = _Rows(schema), None
        for batch in batches:
            for row in batch.to_pylist():
                if total is None or row["conv_id"] != total["conv_id"]:
                    if total is not None:
                        for x in ended(blocks, v, ways, total):
                            yield from out.add(x, 100)
                    total = {"conv_id": row["conv_id"], "first": None, "last": None, "turns": 0, "tail": None} | dict.fromkeys(_COUNTS, 0)
                    blocks, ways, v = [], [], [b and (b[0], (0, b[1])) for b in close([(0, ""), None, None, None])]
                for c in _COUNTS:
                    total[c] += row[c]
                if row["head"] is not None:
                    if total["tail"] is not None:
                        total["illegal"] += total["tail"] + row["head"] not in ("su", "ua", "au")
                    total["tail"] = row["tail"]
                if row["turns"]:
                    total["turns"] += row["turns"] - (total["last"] == row["first"])
                    total["first"] = row["first"] if total["first"] is None else total["first"]
                    total["last"] = row["last"]
                to, way = [], []
                for exit_ in range(4):
                    found = [
                        ((b[0] + row["costs"][4 * e + exit_], (b[1][0], b[1][1] + row["audits"][4 * e + exit_])), e)
                        for e, b in enumerate(v)
                        if b and row["costs"][4 * e + exit_] is not None
                    ]
                    best = min(found, default=(None, -1))
                    to.append(best[0])
                    way.append(best[1])
                # names anew: those that begin with the least of them share its rank
                rank, base, named = -1, None, [None] * 4
                for (r, tail), s in sorted((b[1], s) for s, b in enumerate(to) if b):
                    if base is None or base[0] != r or not tail.startswith(base[1]):
                        rank, base = rank + 1, (r, tail)
                    named[s] = (to[s][0], (rank, tail[len(base[1]) :]))
                v = named
                blocks.append((row["part"], row["k"]))
                ways.append(way)
        if total is not None:
            for x in ended(blocks, v, ways, total):
                yield from out.add(x, 100)
        yield from out.rest()

    return run


def _render(schema: pa.Schema):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows(schema)
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                audit = row["audits"][4 * row["entry"] + row["exit"]]
                layers = [(x["initial"], x["gone"], x["late"], x["role"], x["text"]) for x in row["layers"]]
                text = "".join("\n" + x for x in written(layers, audit, row["entry"])).encode()
                yield from out.add({"conv_id": row["conv_id"], "part": row["part"], "k": row["k"], "entry": row["entry"], "piece": audit, "lines": text}, len(text))
        yield from out.rest()

    return run


def _join(schema: pa.Schema):
    """Pieces in order: their audits joined, their lines hashed one after the other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, conv, now = _Rows(schema), None, None
        for batch in batches:
            for row in batch.to_pylist():
                if now is None or row["conv_id"] != conv:
                    if now is not None:
                        yield from out.add({"conv_id": conv, "audit": "".join(pieces), "sha256": now.hexdigest()}, sum(map(len, pieces)))
                    conv, now, begun = row["conv_id"], hashlib.sha256(), False
                    pieces = ["I" * {START: 0, USER: 1, ASSISTANT: 2}[row["entry"]]]  # before any turn: in no block's table
                    lead = "".join("\n" + x for x in written([], pieces[0], START)).encode()
                    row["lines"] = lead + row["lines"]
                pieces.append(row["piece"])
                now.update(row["lines"] if begun else row["lines"][1:])
                begun = begun or bool(row["lines"])
        if now is not None:
            yield from out.add({"conv_id": conv, "audit": "".join(pieces), "sha256": now.hexdigest()}, 100)
        yield from out.rest()

    return run


def damaged(messages: DataFrame) -> DataFrame:
    """Messages damaged by a rule on their place, with ``n``, how many times each stands there.

    By crc32 of ``conv_id:turn`` modulo 20: 0 drops a row (``n`` is 0), 1 empties
    its text, 2 takes its full stops and question and exclamation marks, 3
    repeats it, 4 makes the user its speaker.  A null reads as one space.
    """
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat_ws(":", shown("conv_id"), shown("turn")).cast("binary")) % 20
    m = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), kind.alias("_kind"))
    return m.select(
        "conv_id", "turn",
        F.when(F.col("_kind") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("_kind") == 0, 0).when(F.col("_kind") == 3, 2).otherwise(1).cast("long").alias("n"),
    )


def repair(messages: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The cheapest edits of each conversation that give the roles ``(s?(ua)+)?`` by their initials.

    ``messages``: conv_id, turn, role, text, and, if there, ``n``: how often the
    row stands there (0: not at all, but its conversation is known).  Null roles
    and texts count as one space; null turns come first, null conversations are
    one conversation; other columns are ignored.  Rows of one turn are ordered
    by role, then text; rows that are wholly alike need no order.

    A row's first fault counts: ``blank`` (nothing but blanks), ``duplicate``
    (role and text were there before in its conversation), ``truncated`` (no
    full stop, question or exclamation mark at its end).  Edits of rows: Keep
    costs 0, Rerole (to user or assistant) 2, Delete 3, which blank and
    duplicate rows must be; truncated rows that are left add 1; a user or
    assistant turn with an empty text may be Inserted anywhere for 2.  Roles
    that begin with none of s, u, a can't be kept.  Of the cheapest edits the
    ASCII-least string of initials is taken.

    Returns a row for each conv_id: ``gaps`` in its turns, ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` (adjacent initials other than su,
    ua, au), ``cost``, ``audit``, ``repaired_sha256`` of the repaired
    ``role:text``, one to a line.  A conversation without rows has zeros, an
    empty audit and the hash of the empty string; no table, no rows.

    A forward Viterbi programme over four grammar states carries the least
    (cost, audit) of each, and closes each turn's layer with at most two
    insertions.  Rows are pre-aggregated, then dealt by ranges of conversation,
    turn and role, so a long conversation lies in many tasks.  A conversation
    within a task's blocks (``block_rows`` turns) is done there.  Of others each
    block gives a table of (cost, audit) from each state to each; the tables of
    a conversation are combined in order, which gives each block's first state,
    and blocks write their lines.  Only the hash of a conversation's lines, which
    no two tasks can share, runs in one task, over pieces that stream by.
    """
    n = F.col("n") if "n" in messages.columns else F.lit(1)
    shown = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = messages.select("conv_id", F.col("turn").cast("long").alias("turn"), shown("role").alias("role"), shown("text").alias("text"), n.cast("long").alias("n"))
    rows = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n")).withColumn("digest", F.unhex(F.sha2("text", 256)))
    who = ["conv_id", "role", "digest"]
    place = F.struct(F.col("turn").isNotNull().alias("some"), "turn")
    alike = [F.col("conv_id").isNull().alias("no_conv"), F.coalesce("conv_id", F.lit(0).cast(messages.schema["conv_id"].dataType)).alias("conv")]
    first = rows.filter("n > 0").groupBy(*who).agg(F.min(place).alias("at")).select(*alike, "role", "digest", "at")
    rows = spread(rows.select("*", *alike), first, ["no_conv", "conv", "role", "digest"], "left")
    rows = rows.select("conv_id", "turn", "role", "text", "n", (F.col("at") == place).alias("is_first"))
    order = ["conv_id", "turn", "role"]
    rows = rows.repartitionByRange(*order, F.substring("text", 1, RANGE_LETTERS)).sortWithinPartitions(*order, "text")
    kind = messages.schema["conv_id"].dataType
    blocks = _arrow(rows, _blocks, _of(kind, _BLOCK), block_rows)
    blocks = materialize(blocks, "repair-blocks")
    done = blocks.filter("not edge").select(
        "conv_id", F.when(F.col("turns") > 0, _gaps()).otherwise(0).alias("gaps"), *_COUNTS, "cost", "audit", F.col("sha256").alias("repaired_sha256")
    )
    edges = blocks.filter("edge")
    small = edges.drop("layers", "edge", "cost", "audit", "sha256").repartition("conv_id").sortWithinPartitions("conv_id", "part", "k")
    ways = materialize(
        _arrow(small, _combine, _of(kind, "whole boolean, " + ", ".join(f"{c} long" for c in (*_COUNTS, "cost", "gaps", "k")) + ", part int, entry int, exit int")), "repair-ways"
    )
    chosen = edges.select("conv_id", "part", "k", "audits", "layers").join(ways.filter("not whole").select("part", "k", "entry", "exit"), ["part", "k"])
    pieces = _arrow(chosen, _render, _of(kind, "part int, k long, entry int, piece string, lines binary"))
    joined = _arrow(pieces.repartition("conv_id").sortWithinPartitions("conv_id", "part", "k"), _join, _of(kind, "audit string, sha256 string"))
    sums = ways.filter("whole").select("conv_id", "gaps", *_COUNTS, "cost").alias("s")
    j = joined.alias("j")
    long = sums.join(j, F.col("s.conv_id").eqNullSafe(F.col("j.conv_id"))).select("s.*", "j.audit", F.col("j.sha256").alias("repaired_sha256"))
    return done.unionByName(long)


def _gaps() -> Column:
    """last - first + 1 - turns, at most what a long holds."""
    wide = F.col("last").cast("decimal(20,0)") - F.col("first") + 1 - F.col("turns")
    return F.least(wide, F.lit(2**63 - 1).cast("decimal(20,0)")).cast("long")


def _arrow(df: DataFrame, make, schema: T.StructType, *more) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema

    return df.mapInArrow(make(to_arrow_schema(schema), *more), schema)
