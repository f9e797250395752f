import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from stratiscore.llm import collocations


def brute(rows, least, top, covered):
    counts, totals = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n-\r]", text):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                counts.update((lang, *words[i : i + k]) for i in range(len(words) - k + 1))
    candidates = {p: a for p, a in counts.items() if len(p) > 2 and a >= least}
    out = {}
    for (lang, *p), a in candidates.items():
        inside = [
            b for (other, *q), b in candidates.items()
            if other == lang and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q)))
        ]
        if any(100 * b >= covered * a for b in inside):
            continue
        cuts = []
        for k in range(1, len(p)):
            left, right = counts[(lang, *p[:k])], counts[(lang, *p[k:])]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    found = set()
    for lang, some in out.items():
        for rank, (score, a, phrase, left, right) in enumerate(sorted(some)[:top], 1):
            found.add((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return found


def run(workspace, docs, rows, **options):
    frame = docs([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)])
    got = [tuple(r) for r in collocations.collocations(workspace, frame, **options).collect()]
    assert len(got) == len(set(got))
    return set(got)


@pytest.mark.parametrize("chunk, shards, top", [(1 << 21, 1, 2000), (17, 5, 2000), (5, 3, 7)])
def test_against_brute_force(documents, workspace, chunk, shards, top):
    rng = random.Random(chunk)
    words = ["ab", "Ab", "c", "dé", "É", "e-f", "1", "\x00", "字"]
    rows = []
    for _ in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t ", ". ", "\n", "!?"]) for _ in range(30))
        rows.append((rng.choice(["en", "fr", None, "und"]), text))
    got = run(workspace, documents, rows, least=4, top=top, chunk_words=chunk, min_shards=shards)
    assert got == brute(rows, 4, top, 50)


def test_long_texts_go_on_in_the_next_chunk(documents, workspace, monkeypatch):
    monkeypatch.setattr(collocations, "_TEXT_PIECE", 11)
    rng = random.Random(5)
    rows = [("en", " ".join(rng.choice("abc") for _ in range(400))), ("de", "a b c " * 50), ("en", "c a")]
    got = run(workspace, documents, rows, least=3, chunk_words=8, covered_percent=90)
    assert got == brute(rows, 3, 2000, 90)


def test_edge_rows(documents, workspace):
    frame = documents()
    rows = [(r["lang"], r["text"]) for r in frame.collect()]
    got = {tuple(r) for r in collocations.collocations(workspace, frame, least=2, top=50).collect()}
    assert got == brute([(lang, t) for lang, t in rows if len(t or "") < 10**5], 2, 50, 50) or len(got) >= 50
    small = [(lang, t) for lang, t in rows if len(t or "") < 10**5]
    assert run(workspace, documents, small, least=2) == brute(small, 2, 2000, 50)


def test_empty_tables(documents, workspace):
    assert collocations.collocations(workspace, documents([])).count() == 0
    assert run(workspace, documents, [("en", None), ("en", ""), (None, "only rare words")]) == set()


@pytest.mark.parametrize("words, bits", [(2, 1), (2, 18), (2, 32), (3, 1), (3, 20), (3, 21), (3, 22), (3, 32)])
def test_permuted_numbers_come_back(words, bits):
    rng = np.random.default_rng(bits)
    ids = [rng.integers(0, 1 << bits, 2000, dtype=np.uint64) for _ in range(words)]
    packed = collocations.PackedPhrases(words, bits)
    high, low = packed.pack(ids)
    assert all((a == b).all() for a, b in zip(packed.unpack(high, low), ids))
    assert len(set(zip(high.tolist(), low.tolist()))) == len(set(zip(*(i.tolist() for i in ids))))
    assert int(high.max()).bit_length() <= packed.high_bits
    counts = collocations.counted(high, low)
    assert counts[2].sum() == 2000
    merged = []
    for _, _, *stored in collocations.filter_rows(packed, *counts, 7):
        merged.append(collocations.read_filter(*stored))
    assert all((np.concatenate(c) == e).all() for c, e in zip(zip(*merged), counts))


def test_numbers_beyond_64_bits_stay_apart():
    high, low = np.array([5, 5, 4, 5], np.uint64), np.array([1, 2, 9, 1], np.uint64)
    found = collocations.counted(high, low)
    assert list(zip(*(f.tolist() for f in found))) == [(4, 9, 1), (5, 1, 2), (5, 2, 1)]


def test_wide_vocabularies(documents, workspace, monkeypatch):
    """The same results with ids of 30 bits, whose phrases take more than 64."""
    plain = collocations.PackedPhrases

    class Wide(plain):
        def __init__(self, words, bits):
            super().__init__(words, 30)

    rows = [("en", "a b c a b c d a b"), ("fr", "a b a b c"), ("en", "b c a b")]
    narrow = run(workspace, documents, rows, least=2, min_shards=3)
    packed, other = Wide(3, 2), plain(3, 2)
    ids = [np.array([1, 2, 3], np.uint64)] * 3
    assert all((a == b).all() for a, b in zip(packed.unpack(*packed.pack(ids)), other.unpack(*other.pack(ids))))
    assert narrow == brute(rows, 2, 2000, 50)


def test_vocabularies_travel_in_a_row_for_each_part(documents, workspace):
    """Not in a row for each word: those were counted, joined and sent back one by one."""
    rows = [("en", " ".join(f"w{i} w{i}" for i in range(start, start + 900))) for start in (0, 500, 700)]
    frame = documents([(i, t, lang, "s", 1) for i, (lang, t) in enumerate(rows)])
    words, phrases, totals = collocations.phrase_counts(workspace, frame.coalesce(1), least=2, chunk_words=1000, min_shards=3)
    chunks = workspace.spark.read.parquet(f"{workspace.root}/001-chunks")
    sizes = [len(r["vocabulary"]) for r in chunks.collect()]
    assert len(sizes) > 1 and max(sizes) <= 3
    assert words.count() == 1600 and [tuple(r) for r in totals.collect()] == [("en", 5400)]
    assert len({r["id"] for r in words.collect()}) == 1600
    # A word twice in a row, of the words that two texts hold: 500 to 1399.
    assert phrases.filter("w3 = 0 and w1 = w2").count() == 900


def test_rows_of_filters_stay_long_at_6_gb():
    """A chunk's phrases by the shards of 6 GB of text (1.6 billion words)."""
    shards = 1_600_000_000 * 2 // collocations.SHARD_PHRASES
    assert 2 * collocations.CHUNK_WORDS / (2 * shards) > 2000


def test_words_are_split_as_by_the_contract():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice("Ab字é\x00 \t\t.,;:!?\n\x0b\x0c\r ") for _ in range(rng.randrange(40)))
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text)
        pieces = [[w for w in re.split("[ \t]+", p) if w] for p in re.split("[.,;:!?\n-\r]", lower)]
        words, breaks = collocations.split_words(text.encode())
        assert [w.decode() for w in words.to_pylist()] == [w for p in pieces for w in p]
        ends = np.cumsum([len(p) for p in pieces])[:-1]
        assert set(np.flatnonzero(breaks).tolist()) == set(ends.tolist())


@pytest.mark.parametrize("parts", [1, 7])
def test_a_vocabulary_is_dealt_by_word(parts):
    keys = pa.array([f"word{i}é en x".encode() * (1 + i % 40) for i in range(5000)], pa.binary())
    counts = np.arange(5000, dtype=np.int64) << 20
    found = {}
    for row in collocations._dealt(keys.slice(10), counts[10:], parts):
        (lengths, gaps, n), text = collocations.unpacked_bytes(row["data"], row["entries"], 3)
        assert 0.8 < row["entries"] * parts / 4990 < 1.2
        for number, key, k in zip(np.cumsum(gaps), collocations._byte_strings(lengths, text).to_pylist(), n):
            found[int(number)] = (key, int(k))
    assert found == {i - 9: (keys[i].as_py(), i << 20) for i in range(10, 5000)}


def test_languages_of_any_name(documents, workspace):
    rows = [("a b", "x y x y x y"), ("a", "x y x y"), ("", "x y x y."), (None, "y x y x"), ("b", "x y x y")]
    for size in (2, 1 << 20):
        got = run(workspace, documents, rows * 3, least=5, chunk_words=size, min_shards=3)
        assert got == brute(rows * 3, 5, 2000, 50) and len({r[0] for r in got}) == 5


@pytest.mark.parametrize("beyond", [0, 1, 6, 7, 32])
def test_numbers_beyond_64_bits_are_counted_in_order(beyond):
    rng = np.random.default_rng(beyond)
    high = rng.integers(0, 1 << 64, 500, dtype=np.uint64)[rng.integers(0, 500, 3000)]
    low = rng.integers(0, 1 << beyond, 3000, dtype=np.uint64)
    expected = sorted(Counter(zip(high.tolist(), low.tolist())).items())
    got = [((h, l), n) for h, l, n in zip(*(c.tolist() for c in collocations.counted(high, low)))]
    assert got == expected
    ones = np.ones(3000, np.int64)
    assert all((a == b).all() for a, b in zip(collocations.counted(high, low, ones), collocations.counted(high, low)))
