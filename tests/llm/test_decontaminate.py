import random

import numpy as np
import pytest

from stratiscore.llm import decontaminate as d
from stratiscore.sources.staging import Workspace

ALPHABET = "abcdefghij klmno"


def distance_in(segment, text):
    """Fewest edits that turn the segment into some part of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(segment):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def edited(rng, text, n):
    out = list(text)
    for _ in range(n):
        i = rng.randrange(len(out))
        out[i : i + 1] = rng.choice(["", "z", out[i] + "z"])
    return "".join(out)


@pytest.mark.parametrize("piece", [1 << 16, 40])
def test_finds_exactly_the_segments_within_their_budget(monkeypatch, piece):
    monkeypatch.setattr(d, "_PIECE", piece)  # texts beyond a piece
    rng = random.Random(2)
    items = [(i, "".join(rng.choice(ALPHABET) for _ in range(rng.randrange(20, 260)))) for i in range(12)]
    index = d.build_index(items, 6, 0.1, 60)
    assert all(b >= 1 for b in index.bounds)
    for _ in range(60):
        _, item = rng.choice(items)
        filler = "".join(rng.choice(ALPHABET) for _ in range(200))
        text = d.normalized(filler + edited(rng, item, rng.randrange(len(item) // 6)) + filler)
        got = {s: edits for s, edits, _ in d.matches(text, index)}
        for s, segment in enumerate(index.texts):
            best = distance_in(segment, text)
            assert (s in got) == (best <= index.budgets[s])
            if s in got:
                assert got[s] == best


def test_alignment_at_the_borders_of_the_text():
    segment, text = (np.array([ord(c) for c in x], np.int64) for x in ("abcdef", "cdef"))
    assert d.align(segment, text, -4, 2, 2) == (2, 4)
    assert d.align(segment, text, -4, 2, 1) is None


@pytest.mark.parametrize("q", [1, 2, 5, 8])
def test_equal_grams_have_equal_hashes(q):
    text = "abcabcabcabcd"
    hashes = d.gram_hashes(d._codes(text), q)
    grams = [text[i : i + q] for i in range(len(text) - q + 1)]
    assert len(hashes) == len(grams)
    assert len(set(zip(grams, hashes.tolist()))) == len(set(grams)) == len(set(hashes.tolist()))


ITEM = "the quick brown fox jumps over the lazy dog while seven wizards brew a quart of vile green potion"


@pytest.mark.parametrize("block_chars", [4_000_000, 50])
def test_documents(documents, table, rows_of, block_chars):
    rows = [
        (1, f"before {ITEM} after", "en", "s", 1),
        (1, f"before {ITEM} after", "en", "s", 1),
        (2, "Clean text that has nothing of it.", "en", "s", 1),
        (3, ITEM.upper().replace(" ", "\n \t"), "en", "s", 1),
        (4, ITEM.replace("wizards", "wizzard"), "en", "s", 1),
        (5, ITEM[: len(ITEM) // 2], "en", "s", 1),
        (6, None, None, None, None),
        (7, "", "en", "s", 0),
        (None, ITEM, "en", "s", 1),
        (8, "word " * 100_000 + ITEM, "en", "s", 1),
    ]
    benchmark = table("item_id long, text string, n int", (7, ITEM, 1), (8, ITEM, 1), (9, None, 1), (10, "short", 1), (None, "", 1))
    docs = documents(rows)
    found = d.contaminated(docs, benchmark, block_chars=block_chars)
    hit = [1, 1, 3, 4, 8, None]
    assert sorted(map(str, ((r["doc_id"], r["item_id"]) for r in found.collect()))) == sorted(
        str((doc, item)) for doc in hit for item in (7, 8)
    )
    kept = d.keep_clean(docs, benchmark, block_chars=block_chars)
    assert kept.schema.names == docs.schema.names
    assert [r["doc_id"] for r in sorted(kept.collect(), key=lambda r: r["doc_id"])] == [2, 5, 6, 7]


def test_repeated_benchmark_rows_count_once(documents, table):
    docs = documents([(1, f"before {ITEM} after", "en", "s", 1)])
    once, often = (table("item_id long, text string", *[(7, ITEM)] * n) for n in (1, 5))
    assert d.contaminated(docs, often).collect() == d.contaminated(docs, once).collect()


def test_empty_tables(documents, table):
    benchmark = table("item_id long, text string", (1, ITEM))
    assert d.contaminated(documents([]), benchmark).count() == 0
    nothing = table("item_id long, text string")
    assert d.contaminated(documents(), nothing).count() == 0
    assert d.keep_clean(documents(), nothing).count() == documents().count()


@pytest.mark.parametrize("length", [120, 121, 143, 200, 240, 290])
def test_verbatim_excerpts_from_every_place_are_found(length):
    rng = random.Random(length)
    item, other = ("".join(rng.choice(ALPHABET) for _ in range(n)).replace(" ", "x") for n in (length, 400))
    index = d.build_index([(1, item), (2, other)], d.Q, d.EDIT_SHARE, d.SEGMENT_CHARS)
    filler = "".join(rng.choice("qrstuvw") for _ in range(90))
    for size in {120, min(150, length)}:
        for at in range(length - size + 1):
            found = d.matches(filler + item[at : at + size] + filler, index)
            assert {index.items[s] for s, *_ in found} == {1}, (size, at)
    assert not d.matches(filler + item[: min(length, 120) * 2 // 3] + filler, index)


def test_excerpts_in_documents(documents, table):
    rng = random.Random(5)
    item = " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(60))[:200]
    docs = documents([(i, f"zz yy {item[a : a + n]} ww", "en", "s", 1) for i, (a, n) in enumerate([(0, 150), (50, 150), (15, 170), (0, 200), (30, 60)])])
    benchmark = table("item_id long, text string", (7, item))
    found = d.contaminated(docs, benchmark).collect()
    assert sorted((r["doc_id"], r["item_id"]) for r in found) == [(i, 7) for i in range(4)]
    assert [r["doc_id"] for r in d.keep_clean(docs, benchmark).collect()] == [4]


def test_blocks_cost_passes_not_memory(spark, documents, table, plan_of, monkeypatch):
    """50 blocks: one broadcast alive at a time, one step in Python per pass, the rows of one block."""
    rng = random.Random(9)
    items = [(f"item {i}", "".join(rng.choice(ALPHABET) for _ in range(150))) for i in range(200)]
    benchmark = table("item_id string, text string", *items)
    rows = [(f"doc {i}", f"zz {rng.choice(items)[1] if i % 3 else 'nothing'} {i}", i, "x") for i in range(60)]
    docs = table("doc_id string, text string, row_id int, `row` string", *rows)
    total = sum(len(t) for _, t in items)
    whole = d.contaminated(docs, benchmark)
    assert dict(whole.dtypes)["doc_id"] == dict(whole.dtypes)["item_id"] == "string"
    kept = d.keep_clean(docs, benchmark)

    alive, most, passes = set(), [], []
    make, stage = spark.sparkContext.broadcast, Workspace.stage

    def shared(value):
        made = make(value)
        alive.add(id(made))
        most.append(len(alive))
        drop = made.destroy
        made.destroy = lambda: (alive.discard(id(made)), drop())
        return made

    def seen(self, df, name):
        passes.append(plan_of(df).count("MapInArrow"))
        return stage(self, df, name)

    monkeypatch.setattr(spark.sparkContext, "broadcast", shared)
    monkeypatch.setattr(Workspace, "stage", seen)
    found = d.contaminated(docs, benchmark, block_chars=total // 50)
    clean = d.keep_clean(docs, benchmark, block_chars=total // 50)
    assert len(most) >= 100 and max(most) == 1 and not alive
    assert max(passes) == 1 and sum(passes) == len(most)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, whole.collect()))
    assert clean.schema == docs.schema == kept.schema
    assert sorted(map(tuple, clean.collect())) == sorted(map(tuple, kept.collect()))
    assert [r["doc_id"] for r in clean.collect() if int(r["doc_id"].split()[1]) % 3] == []
