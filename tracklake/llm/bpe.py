"""Byte-pair encoding and decoding with an index of pair occurrences."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import struct
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import column, texts

#: Words whose encoding a worker keeps, and bytes of text that it takes at a time.
CACHE_WORDS, CHUNK_BYTES = 300_000, 4 << 20


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable in Latin-1, else one from U+0100 on."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(rest)) for b in range(256)]


@functools.cache
def young_letters() -> str:
    """Letters and digits that the pattern library knows and the tokenizers library does not yet."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    known = regex.findall(r"[\p{L}\p{N}]", "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)])))
    recent = "".join(c for c in known if unicodedata.category(c) == "Cn")
    return "".join(part for part, _ in Split(Regex(r"[\p{L}\p{N}]"), "removed").pre_tokenize_str(recent))


@functools.cache
def newer_letters(path: str) -> frozenset[str]:
    """Letters whose normal form Python's Unicode tables do not give as the tokenizers library's do.

    They are those that the library by itself turns into something else; all
    that Python does not know, as they may also join with their neighbours; and
    all marks, as the library's tables, which are older for some and newer for
    others, may give two in a row another order.
    """
    from tokenizers import Tokenizer

    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c) != "|"]
    unknown = set(regex.findall(r"\P{Cn}", "".join(c for c in every if unicodedata.category(c) == "Cn")))
    marks = set(regex.findall(r"\p{M}", "".join(every))) | {c for c in every if unicodedata.combining(c)}
    theirs = Tokenizer.from_file(path).normalizer.normalize_str("|".join(c for c in every if c not in marks)).split("|")
    return frozenset(unknown | marks | {c for c, x in zip((c for c in every if c not in marks), theirs, strict=True) if x != " " and x != plain_form(c)})


def plain_form(text: str) -> str:
    """Composed and in lower case letter by letter: no final sigma."""
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class PairIndex:
    """Encoder of words under a ranked list of merges.

    All words of a call lie in one list of symbols.  An index maps each pair to
    all its positions there; the lowest active rank is applied to all its
    positions, and the lists of the pairs beside them are brought up to date.
    Words do not touch, so the order among them does not matter; within a word
    the order is that of merging the lowest rank, leftmost first.
    """

    def __init__(self, vocab: dict[str, int], merges: list, suffix: str) -> None:
        letters = byte_letters()
        self.first = [vocab[c] for c in letters]
        self.last = [vocab[c + suffix] for c in letters]
        self.rank: dict[tuple[int, int], int] = {}
        self.made: list[tuple[int, int, int]] = []
        for r, pair in enumerate(merges):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            self.rank[vocab[a], vocab[b]] = r
            self.made.append((vocab[a], vocab[b], vocab[a + b]))

    def encode(self, words: list[bytes]) -> list[list[int]]:
        sym: list[int] = []
        after: list[int] = []
        starts = []
        for w in words:
            starts.append(at := len(sym))
            sym += [self.first[b] for b in w[:-1]]
            sym.append(self.last[w[-1]])
            after += range(at + 1, at + len(w))
            after.append(-1)
        before = [-1] * len(sym)
        rank, index = self.rank, {}
        for i, j in enumerate(after):
            if j >= 0:
                before[j] = i
                if (r := rank.get((sym[i], sym[j]))) is not None:
                    index.setdefault(r, []).append(i)
        active = list(index)
        heapq.heapify(active)
        while active:
            r = heapq.heappop(active)
            places = sorted(index.pop(r, ()))
            a, b, new = self.made[r]
            for k, i in enumerate(places):
                j = after[i]
                if sym[i] != a or j < 0 or sym[j] != b:
                    continue  # an earlier merge took one of the two
                sym[i], sym[j] = new, -1
                after[i] = n = after[j]
                lower = False
                if n >= 0:
                    before[n] = i
                    if (q := rank.get((new, sym[n]))) is not None:
                        if q not in index:
                            index[q] = []
                            heapq.heappush(active, q)
                        index[q].append(i)
                        lower = q < r
                if (p := before[i]) >= 0 and (q := rank.get((sym[p], new))) is not None:
                    if q not in index:
                        index[q] = []
                        heapq.heappush(active, q)
                    index[q].append(p)
                    lower |= q < r
                if lower:  # a lower rank became active: it goes first
                    if k + 1 < len(places):
                        index.setdefault(r, []).extend(places[k + 1 :])
                        heapq.heappush(active, r)
                    break
        out = []
        for start in starts:
            ids, i = [], start
            while i >= 0:
                ids.append(sym[i])
                i = after[i]
            out.append(ids)
        return out


class WordBpe:
    """A tokenizer file of word-end BPE: its normaliser, splitter, merges and decoder.

    ``newer`` are letters for which a text is normalised by the library itself.
    """

    def __init__(self, path: str, newer: frozenset[str] | None = None) -> None:
        from tokenizers import Tokenizer

        self.newer = newer_letters(path) if newer is None else newer
        self.normalise = Tokenizer.from_file(path).normalizer.normalize_str
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.index = PairIndex(model["vocab"], model["merges"], model["end_of_word_suffix"])
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t.encode() for t, i in [*model["vocab"].items(), *self.special.items()]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        pattern = split["pattern"]["Regex"]
        self.word = regex.compile(pattern)
        young = young_letters()
        self.young = frozenset(young)
        for kind in ("L", "N"):  # for texts with such letters, a pattern that does not know them
            pattern = pattern.replace(rf"\p{{{kind}}}", rf"[\p{{{kind}}}--[{young}]]" if young else rf"\p{{{kind}}}")
        self.old_word = regex.compile(pattern, regex.V1)
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in self.special) + ")")
        self.known: dict[str, tuple[bytes, bytes]] = {}

    def words(self, text: str) -> list[str]:
        """The words of a text after normalising; special tokens stand for themselves."""
        out: list[str] = []
        for k, part in enumerate(self.cut.split(text)):
            if k % 2:
                out.append(part)
            else:
                word = self.word
                if part.isascii():
                    part = part.lower()
                else:
                    part = plain_form(part) if self.newer.isdisjoint(part) else self.normalise(part)
                    if not self.young.isdisjoint(part):
                        word = self.old_word
                out += word.findall(part)
        return out

    def learn(self, words: set[str]) -> None:
        """Encode the words that are not yet known, all at once."""
        if len(self.known) > CACHE_WORDS:
            self.known.clear()
        if not self.known:
            for t, i in self.special.items():
                self.known[t] = (np.array([i], "<u4").tobytes(), t.encode())
        new = sorted(w for w in words if w not in self.known)
        for w, ids in zip(new, self.index.encode([w.encode() for w in new]), strict=True):
            self.known[w] = (struct.pack(f"<{len(ids)}I", *ids), b" ".join(map(self.token.__getitem__, ids)))

    def encode(self, docs: list[str]) -> Iterator[tuple[bytes, int, bytes]]:
        """Of each text the ids as little-endian bytes, their number, and the text decoded again."""
        split = [self.words(d) for d in docs]
        self.learn(set().union(*split))
        for words in split:
            found = list(map(self.known.__getitem__, words))
            ids = b"".join([f[0] for f in found])
            yield ids, len(ids) // 4, b" ".join([f[1] for f in found])


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """Encode every whole text and decode it again.

    Returns one row per input row: the id, ``n_tokens``, ``ids_sha256`` (of the
    ids as little-endian unsigned 32-bit integers) and ``decoded_sha256``; with
    ``keep`` also ``ids`` and ``decoded``.  Null text counts as empty and has no
    ids.  There is no shuffle: a partition's words go through one pair index,
    in chunks of bounded size.  Whole texts are encoded however long they are;
    repeated rows are encoded each; an empty table gives an empty result; other
    columns, whatever their names, are ignored.
    """
    own = docs.select(column(id_col).alias("id"), column(text_col).alias("text"))
    kind, newer = own.schema["id"].dataType.simpleString(), newer_letters(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(path, newer)

        def chunk(ids: list, part: list[str]) -> pa.RecordBatch:
            done = list(bpe.encode(part))
            cols = {
                "id": pa.concat_arrays(ids),
                "n_tokens": pa.array([d[1] for d in done], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(d[0]).hexdigest() for d in done], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(d[2]).hexdigest() for d in done], pa.string()),
            }
            if keep:
                cols["ids"] = pa.array([np.frombuffer(d[0], "<u4").astype(np.int32) for d in done], pa.list_(pa.int32()))
                cols["decoded"] = pa.array([d[2].decode() for d in done], pa.string())
            return pa.record_batch(cols)

        for batch in batches:
            part, size, at = [], 0, 0
            for i, t in enumerate(texts(batch.column(1))):
                part.append(t.decode("utf-8", "replace"))
                size += len(t)
                if size >= CHUNK_BYTES or i == batch.num_rows - 1:
                    yield chunk([batch.column(0).slice(at, i + 1 - at)], part)
                    part, size, at = [], 0, i + 1

    more = ", ids array<int>, decoded string" if keep else ""
    out = own.mapInArrow(run, f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string{more}")
    return out.withColumnRenamed("id", id_col)
