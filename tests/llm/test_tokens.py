"""BPE and packing against the tokenizers library."""

import hashlib
import random
import unicodedata
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
import regex
from pyspark.sql import types as T
from tokenizers import Tokenizer

from tracklake.llm.bpe import WordBpe, encode_decode
from tracklake.llm.packing import ByteBpe, pack, plan

DOCS = T.StructType([T.StructField(c, k) for c, k in (("doc_id", T.LongType()), ("text", T.StringType()), ("ids", T.StringType()), ("rank", T.StringType()))])


def docs(spark, rows):
    return spark.createDataFrame([(*r, None, None) for r in rows], DOCS)


def odd_texts():
    rng = random.Random(4)
    letters = "aaabcdeéèñßäöü ΣσςİıĳﬁÅÅ \t\n\r\x0b\x0c\x1c\x1f\x85\xa0 　'!?.,0123456789½²ⅣABCXYZ日本語한국😀́​"
    out = ["", " ", "don't we'll I'M THEY'RE", "<|endoftext|> a <|startoftext|>b<|endoftext|><|endoftext", "x" * 5000, "ab" * 3000, " \n" * 4000, "ΟΔΟΣ Σ ΑΣ"]
    out += ["".join(rng.choice(letters) for _ in range(rng.randrange(1, 400))) for _ in range(400)]
    out += [" ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 14))) for _ in range(300)) for _ in range(40)]
    return out


def test_word_bpe_is_the_library(spark):
    rows = list(enumerate([*odd_texts(), None]))
    ref = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    got = {r.doc_id: r for r in encode_decode(docs(spark, rows), P.path("word_bpe_49k.json"), keep=True).collect()}
    for i, t in rows:
        want = ref.encode(t or "", add_special_tokens=False).ids
        assert got[i].ids == want, t
        text = ref.decode(want, skip_special_tokens=False)
        assert got[i].decoded == text
        assert got[i].n_tokens == len(want)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def differing(found):
    bpe, ref = WordBpe(P.path("word_bpe_49k.json")), Tokenizer.from_file(P.path("word_bpe_49k.json"))
    bad = []
    for k in range(0, len(found), 4096):
        part = found[k : k + 4096]
        for text, (ids, n, shown), want in zip(part, bpe.encode(part), ref.encode_batch(part, add_special_tokens=False), strict=True):
            if np.frombuffer(ids, "<u4").tolist() != want.ids or n != len(want.ids):
                bad.append(text)
    return bad


def test_marks_in_a_row():
    """Every mark before and after marks of other classes: they change places as the library has it."""
    marks = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (unicodedata.combining(chr(c)) or regex.match(r"\p{M}", chr(c)))]
    assert len(marks) > 2000
    assert not differing([f"a{x}{y}" for m in marks for other in "\u0316\u0301\u0334\u0651\u0345" for x, y in ((m, other), (other, m))])


def test_random_texts_of_marks_letters_and_special_tokens():
    rng = random.Random(1)
    marks = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and regex.match(r"\p{M}", chr(c))]
    letters = [*"aeiouAEIOUéèñßäöüÅİıΣσςѝйㄱ가각각한 .,!'1½", "<|endoftext|>", "<|startoftext|>", "\u00c5", "\u1e9b"]
    texts = ["".join(rng.choice(marks if rng.random() < 0.4 else letters) for _ in range(rng.randrange(1, 14))) for _ in range(50_000)]
    assert not differing(texts)
    ref = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    bpe = WordBpe(P.path("word_bpe_49k.json"))
    for text, want in zip(texts[:3000], ref.encode_batch(texts[:3000], add_special_tokens=False), strict=True):
        assert next(bpe.encode([text]))[2].decode() == ref.decode(want.ids, skip_special_tokens=False)


@pytest.mark.parametrize("frame", ["a{}B", "1{}2 {}{}é"])
def test_every_letter(frame):
    """All of Unicode but unassigned planes, in two contexts: not one letter may give other ids."""
    bpe, ref = WordBpe(P.path("word_bpe_49k.json")), Tokenizer.from_file(P.path("word_bpe_49k.json"))
    letters = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and not 0x33500 <= c < 0xE0000]
    bad = []
    for k in range(0, len(letters), 4096):
        part = letters[k : k + 4096]
        found = [frame.format(*[c] * frame.count("{}")) for c in part]
        ours = [np.frombuffer(e[0], "<u4").tolist() for e in bpe.encode(found)]
        bad += [c for c, x, r in zip(part, ours, ref.encode_batch(found, add_special_tokens=False)) if x != r.ids]
    assert not bad, (len(bad), [hex(ord(c)) for c in bad[:50]])


def test_newer_letters_join_with_their_neighbours():
    bpe, ref = WordBpe(P.path("word_bpe_49k.json")), Tokenizer.from_file(P.path("word_bpe_49k.json"))
    marks = ["\u0307", "\u0301", *map(chr, (0x113B8, 0x113BB, 0x113C2, 0x113C5, 0x113C9, 0x16D63, 0x16D67, 0x105D2, 0x105DA, 0x11382, 0x1138B))]
    found = [f"x{a}{b} {b}{a}{a}" for a in marks for b in marks]
    ours = [np.frombuffer(e[0], "<u4").tolist() for e in bpe.encode(found)]
    assert ours == [r.ids for r in ref.encode_batch(found, add_special_tokens=False)]


def test_byte_bpe_is_the_library():
    ours, ref = ByteBpe(P.path("byte_bpe_50k.json")), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    for t in odd_texts():
        assert ours(t).tolist() == ref.encode(t, add_special_tokens=False).ids, t


@pytest.mark.parametrize("seed", range(4))
def test_plan_places_every_piece(seed):
    rng = np.random.default_rng(seed)
    window = 64
    lengths = [rng.integers(1, window + 1, 5000), np.minimum(window, rng.geometric(0.2, 5000)), np.full(999, 33), np.array([], int)][seed]
    hist = np.bincount(lengths, minlength=window + 1)
    used = np.zeros(window + 1, int)
    n = 0
    for need, times in plan(hist, window):
        assert times > 0 and sum(a * m for a, m in need) <= window
        for a, m in need:
            used[a] += m * times
        n += times
    assert (used == hist).all()
    if seed < 2:
        assert lengths.sum() / (n * window) > 0.99


def test_pack(spark):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choice(["alpha", "beta", "é", "gamma!"]) for _ in range(rng.choice([0, 3, 50, 400, 5000])))) for i in range(400)]
    rows += [(400, None), (401, ""), (402, "hot"), *[(k, "hot") for k in range(403, 900)], (7, rows[7][1]), (None, "no id")]
    ref = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = pack(docs(spark, rows), P.path("byte_bpe_50k.json")).collect()
    ids = {i: [*ref.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}
    seqs, whole = defaultdict(list), defaultdict(list)
    for r in got:
        own = ids[r.doc_id]
        assert r.doc_tokens == len(own) and 0 < r.length and r.start + r.length <= len(own)
        assert r.ids_crc32 == zlib.crc32(np.array(own[r.start : r.start + r.length], "<u4").tobytes())
        seqs[r.sequence_id].append((r.offset, r.length))
        whole[r.doc_id].append((r.start, r.length))
    for parts in seqs.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    copies = defaultdict(int)
    for i, _ in rows:
        copies[i] += 1
    for i, own in ids.items():
        assert sum(n for _, n in whole[i]) == len(own) * copies[i]
        assert len(set(whole[i])) * copies[i] == len(whole[i])
    assert sorted(seqs) == list(range(len(seqs)))
    assert pack(docs(spark, []), P.path("byte_bpe_50k.json")).collect() == []
    assert encode_decode(docs(spark, []), P.path("word_bpe_49k.json")).collect() == []
