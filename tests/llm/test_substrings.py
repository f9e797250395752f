import hashlib
import random
from collections import defaultdict

import pytest

from stratiscore.llm import substrings


def brute(rows, window):
    first = {}
    docs = [(d, (t or "").split()) for d, t in rows]
    for doc_id, words in docs:
        for i in range(len(words) - window + 1):
            if doc_id is not None:
                k = tuple(words[i : i + window])
                first[k] = min(doc_id, first.get(k, doc_id))
    out = defaultdict(int)
    for doc_id, words in docs:
        gone = set()
        for i in range(len(words) - window + 1):
            if doc_id is not None and first[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out[(doc_id, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest(), kept)] += 1
    return out


def found(df):
    out = defaultdict(int)
    for row in df.collect():
        out[tuple(row)] += 1
    return out


@pytest.mark.parametrize("blocks, window", [(1, 4), (7, 4), (40, 1)])
def test_against_brute_force(documents, blocks, window):
    rng = random.Random(blocks)
    rows = [(i * 3, " ".join(rng.choice("abc") for _ in range(rng.randrange(40)))) for i in range(60)]
    rows += [(10**6, rows[3][1]), (10**6, rows[4][1]), (-5, "a b c a b c"), (None, rows[3][1])]
    docs = documents([(d, t, "en", "s", 1) for d, t in rows])
    got = substrings.remove_repeated(docs, window, min_blocks=blocks, with_text=True)
    assert found(got) == brute(rows, window)


def test_edge_rows(documents):
    docs = documents()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert found(substrings.remove_repeated(docs, with_text=True)) == brute(rows, 50)


def test_empty_table(documents):
    assert substrings.remove_repeated(documents([])).count() == 0


@pytest.mark.parametrize("piece", [1 << 21, 5])
def test_hashes_depend_on_the_words_only(monkeypatch, piece):
    monkeypatch.setattr(substrings, "_PIECE", piece)
    texts = [b"one two three four", b"  zero one\n\ttwo  three ", b"", b" ", "é two three".encode()]
    counts, starts, hashes = substrings.block_windows(texts, 2)
    assert counts.tolist() == [4, 4, 0, 0, 3]
    words = [t.split() for t in texts]
    flat = [w for ws in words for w in ws]
    grams = [tuple(flat[i : i + 2]) for i in starts.tolist()]
    assert grams == [tuple(ws[i : i + 2]) for ws in words for i in range(len(ws) - 1)]
    assert len(set(zip(grams, hashes.tolist()))) == len(set(grams)) == len(set(hashes.tolist()))


def test_blocks_hold_about_equal_bytes(workspace, documents):
    """Long texts next to each other do not end up in one block."""
    rows = [(i, "word " * (20_000 if 100 <= i < 112 else 4), "en", "s", 1) for i in range(1200)]
    rows += [(None, "x " * 99, "en", "s", 1), (5, None, "en", "s", 1)]
    docs = documents(rows).select("doc_id", "text")
    n, starts = substrings.block_starts(workspace, docs, 1 << 30, 6)
    assert n == 6
    held = [0] * 6
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            held[sum(doc_id >= s for s in starts)] += len(text or "") + 1
    share, largest = sum(held) / 6, 100_001
    assert max(held) <= share + largest and min(held) >= share - largest
    assert substrings.block_starts(workspace, docs, 100_000, 1)[0] == -(-sum(held) // 100_000)
    assert substrings.block_starts(workspace, documents([]).select("doc_id", "text"), 10, 4) == (4, [])
