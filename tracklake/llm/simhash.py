"""Near-duplicates by SimHash fingerprints, compared exactly in tiles."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, materialize, mix, numbered, spread, texts
from .components import connected_components

#: Fingerprints in a tile, and the most tiles there may be; beyond that, tiles
#: grow, so that the table of tile bounds stays under a few MB at any size.
TILE, MOST_TILES = 2048, 65_536
#: Groups of tiles that squares are made of, as far as a group, which a task
#: holds, stays within MOST_SIDE tiles (4 MB); and the most partitions of squares.
GROUPS, MOST_SIDE, MOST_SQUARES = 24, 256, 4096
#: Population counts are taken of the 64 bits whole and in so many equal parts.
PARTS = (1, 2, 4, 8)
#: Hashes for further 64 bits are scrambled after so many steps of this size.
STEP = 0x9E3779B97F4A7C15


def fingerprint(text: bytes, shingle: int = 4, seed: int = 42) -> int:
    """The 64-bit SimHash of a text's word shingles, as an unsigned number."""
    return int(wide_fingerprint(text, shingle, 1, seed)[0])


def wide_fingerprint(text: bytes, shingle: int, words64: int, seed: int = 42) -> np.ndarray:
    """The SimHash of ``words64`` times 64 bits; the first 64 are those of ``fingerprint``."""
    words = text.lower().split()
    if not words:
        return np.zeros(words64, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= shingle:
        spans = [(0, len(joined))]
    else:
        starts = np.concatenate(([0], ends[: -shingle] + 1))
        spans = zip(starts.tolist(), ends[shingle - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], seed) for i, j in spans], dtype=np.uint64)
    ones = np.zeros((words64, 64), dtype=np.int64)
    for at in range(0, len(hashes), 65_536):
        for k in range(words64):
            part = hashes[at : at + 65_536]
            part = (mix(part + np.uint64(k * STEP % (1 << 64))) if k else part).astype(">u8").view(np.uint8).reshape(-1, 8)
            ones[k] += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    return np.packbits(2 * ones > len(hashes), axis=1).view(">u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str, text_col: str, shingle: int, words64: int = 1) -> DataFrame:
    """Columns ``id``, ``digest`` (a hash of the text) and ``fp`` (the first 64 bits of the fingerprint as a signed bigint).

    Wide fingerprints have ``more`` (the other bits) and ``node``, a hash of all bits that names the fingerprint.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [wide_fingerprint(t, shingle, words64) for t in texts(batch.column(2))]
            first = pa.array(np.array([f[0] for f in found], dtype=np.uint64).view(np.int64))
            more = {"more": pa.array([f[1:].tobytes() for f in found], pa.binary())} if words64 > 1 else {}
            yield pa.record_batch({"id": batch.column(0), "digest": batch.column(1), "fp": first} | more)

    own = docs.select(column(id_col).alias("id"), F.xxhash64(column(text_col)).alias("digest"), column(text_col).alias("text"))
    schema = f"id {own.schema['id'].dataType.simpleString()}, digest long, fp long"
    if words64 == 1:
        return own.mapInArrow(run, schema)
    return own.mapInArrow(run, f"{schema}, more binary").withColumn("node", F.xxhash64("fp", "more"))


def _node(fps: DataFrame) -> str:
    """The column that names a fingerprint."""
    return "node" if "more" in fps.columns else "fp"


def _counts(fps: np.ndarray) -> np.ndarray:
    """Population counts of each fingerprint whole, of its halves, quarters and bytes, one row each."""
    of_bytes = np.bitwise_count(fps.astype(">u8").view(np.uint8).reshape(-1, 8))
    return np.concatenate([of_bytes.reshape(-1, p, 8 // p).sum(axis=2, dtype=np.uint8) for p in PARTS], axis=1)


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    """A row for each fingerprint: its bits, or, if they are wide, its name and then its bits."""
    whole = [batch.column(c).to_numpy(zero_copy_only=False).view(np.uint64)[:, None] for c in batch.schema.names if c != "more"]
    if "more" in batch.schema.names:
        whole.append(np.frombuffer(b"".join(batch.column("more").to_pylist()), np.uint64).reshape(batch.num_rows, -1))
    return np.concatenate(whole, axis=1)


def _bits(fps: np.ndarray) -> np.ndarray:
    """The bits alone of such rows."""
    return fps[:, 1:] if fps.shape[1] > 1 else fps


def _tiles(size: int, columns: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cut a sorted partition into tiles: an id, the fingerprints, bounds of their first 64 bits' counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        pid, k, rest = TaskContext.get().partitionId(), 0, np.empty((0, columns), np.uint64)

        def tile(part: np.ndarray) -> pa.RecordBatch:
            c = _counts(_bits(part)[:, 0])
            return pa.record_batch(
                {
                    "tile": pa.array([pid * (1 << 32) + k], pa.int64()),
                    "fps": pa.array([part.tobytes()], pa.binary()),
                    "low": pa.array([c.min(axis=0).tobytes()], pa.binary()),
                    "high": pa.array([c.max(axis=0).tobytes()], pa.binary()),
                }
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            rest = np.concatenate((rest, _matrix(batch)))
            while len(rest) >= size:
                yield tile(rest[:size])
                rest, k = rest[size:], k + 1
        if len(rest):
            yield tile(rest)

    return run


def _apart(low: np.ndarray, high: np.ndarray, of: int, to: np.ndarray | slice) -> np.ndarray:
    """The least number of bits by which fingerprints of tile ``of`` and of the tiles ``to`` differ, as their counts say.

    The counts of disjoint parts differ, in sum, by no more than the bits do;
    each way to cut the bits gives a bound.
    """
    cuts = np.cumsum((0, *PARTS))
    gap = np.maximum(0, np.maximum(low[to] - high[of], low[of] - high[to]))
    return np.max([gap[:, a:b].sum(axis=1) for a, b in zip(cuts, cuts[1:], strict=False)], axis=0)


def _deal(number: dict[int, int], low: np.ndarray, high: np.ndarray, radius: int, side: int):
    """Send each tile to the squares of ``side`` x ``side`` tiles in which it has a pair to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, rank, a, b = [], [], [], []
            for i, tile in enumerate(batch.column("tile").to_pylist()):
                own = number[tile]
                for other in np.unique(np.flatnonzero(_apart(low, high, own, slice(None)) <= radius) // side).tolist():
                    row.append(i)
                    rank.append(own)
                    a.append(min(own // side, other))
                    b.append(max(own // side, other))
            fps = batch.column("fps").take(pa.array(row, pa.int64()))
            yield pa.record_batch([*(pa.array(x, pa.int32()) for x in (a, b, rank)), fps], names=["a", "b", "tile", "fps"])

    return run


def _links(a: np.ndarray, b: np.ndarray, same: bool, radius: int, first: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links between two tiles, as (fingerprint's name, root).

    Every pair is compared in its first 64 bits, those within ``first`` in all
    bits; a dense group then gives one link for each of its members and not
    one for each pair.
    """
    nodes = a[:, 0] if same else np.concatenate((a[:, 0], b[:, 0]))
    shift = 0 if same else len(a)
    a, b = _bits(a), _bits(b)
    u, v = np.ascontiguousarray(a[:, 0]), np.ascontiguousarray(b[:, 0])
    label = np.arange(len(nodes))
    strip = max(1, (1 << 16) // max(1, len(b)))  # what a strip needs stays in a core's cache
    for at in range(0, len(a), strip):
        hit = np.bitwise_count(u[at : at + strip, None] ^ v[None, :]) <= first
        if same:
            hit &= np.arange(len(b))[None, :] > np.arange(at, at + len(hit))[:, None]
        if a.shape[1] > 1:
            x, y = np.divmod(np.flatnonzero(hit), len(b))
            far = np.bitwise_count(a[x + at] ^ b[y]).sum(axis=1, dtype=np.int64) > radius
            hit[x[far], y[far]] = False
        for i in np.flatnonzero(hit.any(axis=1)):
            own = np.append(label[np.flatnonzero(hit[i]) + shift], label[at + i])
            root = own.min()
            if (own != root).any():
                label[np.isin(label, own)] = root
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def _compare(low: np.ndarray, high: np.ndarray, radius: int, first: int, side: int, columns: int):
    """Links within squares; tiles come sorted by square and number, so the first group of a square is held and the second streams past it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        square, held = None, []
        for batch in batches:
            for a, b, tile, fps in zip(*(batch.column(c).to_pylist() for c in ("a", "b", "tile", "fps")), strict=True):
                if square != (a, b):
                    square, held = (a, b), []
                own = np.frombuffer(fps, np.uint64).reshape(-1, columns)
                if tile // side == a:
                    held.append((tile, own))
                    if a != b:
                        continue
                near = _apart(low, high, tile, np.array([t for t, _ in held], np.int64)) <= first if held else ()
                for (t, other), go in zip(held, near, strict=True):
                    if go:
                        u, v = _links(other, own, t == tile, radius, first)
                        if len(u):
                            yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

    return run


def near_fingerprints(fps: DataFrame, radius: int, first: int | None = None) -> DataFrame:
    """Links (``u``, ``v``) that connect all distinct fingerprints within the radius.

    Of wide fingerprints the first 64 bits must, besides, lie within ``first``,
    which is what tiles are sorted, skipped and first compared by.

    Distinct fingerprints are sorted by their population count, then that of
    one half, of one quarter in each half, of one byte in each quarter, and cut
    into tiles.  The counts of two fingerprints differ by no more than their
    bits, so a pair of tiles whose counts lie further apart than the radius is
    skipped; of the others every pair of fingerprints is compared.  The more
    tiles there are, the narrower their counts and the more pairs are skipped.
    Tiles meet in squares of two groups of neighbouring tiles, so a tile travels
    once for each group that it has a pair in, not once for each pair.
    """
    spark = fps.sparkSession
    first, columns = radius if first is None else min(first, radius), 1
    if "more" in fps.columns:
        distinct = materialize(fps.select("node", "fp", "more").distinct(), "distinct-fps")
        columns = 2 + (distinct.agg(F.max(F.octet_length("more"))).first()[0] or 0) // 8
    else:
        distinct = materialize(fps.select("fp").distinct(), "distinct-fps")
    n = distinct.count()
    size = max(TILE, -(-n // MOST_TILES))
    key, free = F.shiftleft(F.bit_count("fp").cast("bigint"), 56), 56
    for p in PARTS[1:]:
        bits = 64 // p
        mask = F.lit((1 << bits) - 1).cast("bigint")
        for i in range(p - 1, 0, -2):
            free -= bits.bit_length()
            key = key.bitwiseOR(F.shiftleft(F.bit_count(F.shiftrightunsigned("fp", bits * i).bitwiseAND(mask)).cast("bigint"), free))
    key = key.bitwiseOR(F.col("fp").bitwiseAND(F.lit((1 << free) - 1)))  # one number, so the splitters' sample is small
    keyed = distinct.select("*", key.alias("key"))
    tiles = keyed.repartitionByRange(max(1, -(-n // size)), "key").sortWithinPartitions("key").drop("key")
    tiles = materialize(tiles.mapInArrow(_tiles(size, columns), "tile long, fps binary, low binary, high binary"), "tiles")
    bounds = sorted(tiles.select("tile", "low", "high").collect())  # MOST_TILES rows at most, and one for each partition
    if not bounds:
        return spark.createDataFrame([], "u long, v long")
    low, high = (np.array([np.frombuffer(bytes(r[k]), np.uint8) for r in bounds], np.int16) for k in (1, 2))
    side = min(MOST_SIDE, -(-len(bounds) // GROUPS))
    groups = -(-len(bounds) // side)
    dealt = tiles.select("tile", "fps").mapInArrow(_deal({r[0]: k for k, r in enumerate(bounds)}, low, high, first, side), "a int, b int, tile int, fps binary")
    dealt = dealt.repartition(min(groups * (groups + 1) // 2, MOST_SQUARES), "a", "b").sortWithinPartitions("a", "b", "tile")
    return dealt.mapInArrow(_compare(low, high, radius, first, side, columns), "u long, v long")


def _roots(fps: DataFrame, radius: int, first: int | None = None) -> DataFrame:
    """Each distinct fingerprint's name with the ``root`` of its component and ``own``, the smallest id that has it."""
    node = _node(fps)
    links = connected_components(near_fingerprints(fps, radius, first))
    own = fps.groupBy(node).agg(F.min("id").alias("own"))
    rooted = own.join(links, own[node] == links["u"], "left").select(node, F.coalesce("root", node).alias("root"), "own")
    return materialize(rooted, "rooted")


def simhash_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, radius: int = 4
) -> DataFrame:
    """Fingerprint every whole text and join those linked within ``radius`` bits.

    Returns one row per input row: the id, ``fingerprint`` (16 hex digits) and
    ``component_id``, the smallest id that links lead to.  Null or blank text
    has fingerprint zero, which links like any other.  Texts of any length are
    read whole.  Repeated rows are rows each.  A component all of whose ids are
    null has a null ``component_id``.  An empty table gives an empty result;
    other columns, whatever their names, are ignored.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "fps")
    rooted = _roots(fps, radius)
    best = rooted.groupBy("root").agg(F.min("own").alias("component_id"))
    named = materialize(spread(rooted, best, ["root"]).select("fp", "component_id"), "named")
    return fps.join(named, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def near_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, radius: int = 46, first: int = 16, words64: int = 4
) -> DataFrame:
    """The rows of ``docs``, all columns, but of each component only the one with the smallest id.

    By default fingerprints have 256 bits.  Texts of which four fifths of the
    five-word shingles are common differ in 39 of them on average, with a
    standard deviation of 6, and are linked nine times in ten; of texts with half
    of them in common, fewer than one pair in a thousand is.  A fingerprint of
    64 bits cannot tell these apart: 10 and 17 bits, with deviations of 3 and 4.
    Rows without an id come last; among rows that share the smallest id one
    text stays, with its exact repeats, if there are any.  Columns of any names
    pass through.  An empty table gives an empty result.
    """
    rows, (i, t) = numbered(docs, id_col, text_col)
    fps = materialize(fingerprints(rows, i, t, shingle, words64), "fps")
    best = fps.join(_roots(fps, radius, first), _node(fps))
    best = best.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "digest")).alias("best"))
    kept = materialize(best.select(F.col("best.id").alias("id"), F.col("best.digest").alias("digest")), "kept")
    match = rows[i].eqNullSafe(kept["id"]) & (F.xxhash64(rows[t]) == kept["digest"])
    return rows.join(kept, match, "left_semi").toDF(*docs.columns)
