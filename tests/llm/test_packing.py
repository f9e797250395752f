import random
import zlib
from collections import Counter
from itertools import product

import numpy as np
import pytest
from tokenizers import Tokenizer

from stratiscore.llm import packing


@pytest.fixture(scope="module")
def definition():
    with open(packing.tokenizer_file(), "rb") as file:
        return file.read()


WHITE = ["a  b", " ", "\n", " \n ", "a ", " a", "a \n", "x\ny z\n", "a \n b c", "  ", "\x1c a b", "a\x85 b",
         "", "don't 'll we 12 3a\tb", "字 字 字", "a\n b \n\n c", "x <|endoftext|> y", "　 a"]


def test_ids_are_those_of_whole_texts(definition):
    rng = random.Random(1)
    texts = WHITE + ["".join(rng.choice(" \n\tab'1.é") for _ in range(rng.randrange(40))) for _ in range(500)]
    plain = Tokenizer.from_buffer(definition)
    expected = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    encoder = packing.Encoder(definition)
    assert encoder.ranked is not None
    assert [encoder.encode(t).tolist() for t in texts] == expected


def test_ids_of_every_character(definition):
    plain, encoder = Tokenizer.from_buffer(definition), packing.Encoder(definition)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for start in range(0, len(points), 4000):
        text = "".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}-{chr(c)}{chr(c)}  " for c in points[start : start + 4000])
        assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_long_runs(definition):
    plain, encoder = Tokenizer.from_buffer(definition), packing.Encoder(definition)
    for text in (" " * 300_000 + "x", "\n" * 300_000, "a" * 300_000, " \n" * 150_000 + "y"):
        assert encoder.encode(text).tolist() == plain.encode(text, add_special_tokens=False).ids


def test_other_tokenizers_are_used_as_they_are():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), "rb") as file:
        other = file.read()
    encoder = packing.Encoder(other)
    assert encoder.ranked is None
    expected = Tokenizer.from_buffer(other).encode("Some Words, here", add_special_tokens=False).ids
    assert encoder.encode("Some Words, here").tolist() == expected


def closest_by_trial(counts, capacity):
    choices = product(*(range(c + 1) for c in counts.values()))
    sums = (sum(n * k for n, k in zip(counts, some)) for some in choices)
    return max(s for s in sums if s <= capacity)


def test_closest_filling_against_all_choices():
    rng = random.Random(2)
    for _ in range(200):
        counts = {rng.randrange(1, 30): rng.randrange(1, 4) for _ in range(rng.randrange(1, 6))}
        capacity = rng.randrange(0, 60)
        filling = packing.closest_filling(counts, capacity)
        assert all(filling[n] <= counts[n] for n in filling)
        assert sum(n * k for n, k in filling.items()) == closest_by_trial(counts, capacity)


def test_patterns_use_every_piece_once():
    rng = random.Random(3)
    histogram = dict(Counter(rng.randrange(1, 101) for _ in range(5000)))
    histogram[100] = 10**12  # counts of any size take few steps
    patterns = packing.minimum_slack(histogram, 100)
    used = Counter()
    for p in patterns:
        assert sum(n * k for n, k in p.filling) <= 100
        used.update({n: k * p.windows for n, k in p.filling})
    assert used == histogram
    assert len(patterns) < 1000


def check(rows, docs, window, definition):
    plain = Tokenizer.from_buffer(definition)
    ids = [plain.encode(t or "", add_special_tokens=False).ids + [1] for _, t in docs]
    expected = Counter()
    for (doc_id, _), i in zip(docs, ids):
        for s in range(0, len(i), window):
            check = zlib.crc32(np.array(i[s : s + window], "<u4").tobytes())
            expected[(doc_id, s, len(i[s : s + window]), check, len(i))] += 1
    assert Counter(tuple(r)[:5] for r in rows) == expected
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= window
    assert sorted(sequences) == list(range(len(sequences)))
    return len(sequences), sum(map(len, ids))


@pytest.mark.parametrize("window", [7, 64, 2048])
def test_whole_query(documents, window, definition):
    rng = random.Random(window)
    texts = [" ".join(rng.choice(["alpha", "be", "c", "delta!"]) for _ in range(rng.randrange(60))) for _ in range(300)]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[3]), (None, texts[4]), (None, None), (-1, "")]
    frame = documents([(d, t, "en", "s", 1) for d, t in docs])
    from stratiscore.sources.staging import Workspace

    rows = packing.pack(Workspace(frame.sparkSession), frame, window).collect()
    n, total = check(rows, docs, window, definition)
    assert n <= -(-total // window) + 1


def test_edge_rows_and_sequences(documents, workspace, definition):
    frame = documents()
    docs = [(r["doc_id"], r["text"]) for r in frame.collect()]
    packed = workspace.stage(packing.pack(workspace, frame, with_ids=True), "packed")
    check(packed.drop("ids").collect(), docs, 2048, definition)
    made = packing.sequences(packed).collect()
    total = sum(r["n_tokens"] for r in made)
    assert total == sum(r["length"] for r in packed.select("length").collect())
    for r in made:
        assert len(r["ids"]) == (r["n_tokens"] if r["n_tokens"].bit_count() == 1 else 2048)


def test_empty_table(documents, workspace):
    assert packing.pack(workspace, documents([])).count() == 0
