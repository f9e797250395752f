import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from stratiscore.llm import simhash
from stratiscore.llm.components import components


def plain_fingerprint(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, distance=2):
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def classes(labels):
    found = {}
    for i, label in enumerate(labels):
        found.setdefault(label, set()).add(i)
    return sorted(map(sorted, found.values()))


@pytest.mark.parametrize("piece", [1 << 21, 7])
def test_fingerprints_follow_the_definition(monkeypatch, piece):
    monkeypatch.setattr(simhash, "_PIECE", piece)
    rng = random.Random(3)
    texts = ["", " ", "one", "One two", "A b  c", "É Ä ß x y z", "a " * 500]
    texts += [" ".join(rng.choice("abcdeXYZ") for _ in range(rng.randrange(60))) for _ in range(60)]
    for text in texts:
        assert simhash.fingerprint(text.encode()) % (1 << 64) == plain_fingerprint(text)


@pytest.mark.parametrize("limit, segments", [(64, 8), (1, 8), (3, 4), (64, 16)])
def test_links_have_the_components_of_all_pairs(spark, workspace, limit, segments):
    rng = random.Random(limit * 100 + segments)
    prints = set()
    for _ in range(25):
        seed = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 9)):
            prints.add(seed)
            for _ in range(rng.randrange(4)):
                seed ^= 1 << rng.randrange(64)
    prints |= {0, (1 << 64) - 1, 1 << 63, 3}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.links(workspace, distinct, 2, segments, limit)
    place = {p: i for i, p in enumerate(signed)}
    for a, b in edges.collect():
        assert bin(prints[place[a]] ^ prints[place[b]]).count("1") <= 2
    roots = {r["node"]: r["root"] for r in components(workspace, edges).collect()}
    assert classes([roots.get(p, p) for p in signed]) == classes(brute_components(prints))


def test_edge_rows(workspace, documents):
    docs = documents()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = simhash.near_duplicates(workspace, docs).collect()
    labels = brute_components([plain_fingerprint(t) for _, t in rows])
    least = {}
    for (doc_id, _), label in zip(rows, labels):
        least.setdefault(label, []).append(doc_id)
    wanted = Counter(
        (d, plain_fingerprint(t), min((x for x in least[lab] if x is not None), default=None))
        for (d, t), lab in zip(rows, labels)
    )
    assert Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in found) == wanted
    kept = simhash.keep_first(workspace, docs)
    assert kept.columns == docs.columns and kept.count() == len(set(labels))


def test_an_id_on_two_rows_loses_no_text(workspace, documents):
    one, other = "alpha beta gamma delta " * 9, "completely different words stand here today " * 9
    rows = [(1, one), (1, other), (2, one + "!"), (2, one + "!"), (None, other), (3, "third text of its own")]
    docs = documents([(i, t, "en", "s", 1) for i, t in rows])
    kept = [(r["doc_id"], r["text"]) for r in simhash.keep_first(workspace, docs).collect()]
    labels = brute_components([plain_fingerprint(t) for _, t in rows])
    wanted = {}
    for (doc_id, text), label in zip(rows, labels):
        wanted.setdefault(label, set()).add((doc_id is None, doc_id or 0, text))
    assert len(kept) == len(wanted)
    assert {(i is None, i or 0) for i, _ in kept} <= {min(w)[:2] for w in wanted.values()}
    assert {one, other, "third text of its own"} <= {t for _, t in kept} | {one}


def test_empty_table(workspace, documents):
    assert simhash.near_duplicates(workspace, documents([])).count() == 0
    assert simhash.keep_first(workspace, documents([])).count() == 0


def test_odd_distances_are_refused(spark, workspace):
    with pytest.raises(ValueError):
        simhash.links(workspace, spark.createDataFrame([(1,)], "fp long"), 3)


def test_long_chains_and_hubs(spark, workspace):
    rng = np.random.default_rng(1)
    chain = [(int(i), int(i) + 1) for i in rng.permutation(300)]
    hub = [(1000, 1000 + i) for i in range(1, 200)]
    edges = spark.createDataFrame([*chain, *hub, (5, 5)], "a long, b long")
    roots = {r["node"]: r["root"] for r in components(workspace, edges).collect()}
    assert roots == {i: 0 for i in range(1, 301)} | {1000 + i: 1000 for i in range(1, 200)}
