import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from stratiscore.llm.sharding import Order, assign_shards


def greedy(sizes, n):
    """Smallest capacity by trial, and the groups that begin a shard."""

    def cuts(capacity):
        found, filled = [], 0
        for i, size in enumerate(sizes):
            if filled + size > capacity:
                found.append(i)
                filled = 0
            filled += size
        return found

    capacity = max(sizes)
    while len(cuts(capacity)) + 1 > n:
        capacity += 1
    return capacity, cuts(capacity)


def expected(rows, n):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        digest = b"" if text is None else hashlib.sha256(text.encode()).digest()
        groups[digest].append((doc_id, text or ""))
    ordered = [
        sorted(members, key=lambda m: (m[0] is not None, m[0])) for _, members in sorted(groups.items())
    ]
    sizes = [sum(len(t.encode()) + 8 for _, t in members) for members in ordered]
    _, cuts = greedy(sizes, n)
    out, shard, slot = [], 0, 0
    for i, members in enumerate(ordered):
        if i in cuts:
            shard, slot = shard + 1, 0
        for doc_id, text in members:
            out.append((doc_id, len(text.encode()) + 8, zlib.crc32(text.encode()), shard, slot))
            slot += 1
    return sorted(out, key=lambda r: [(v is not None, v) for v in r])


@pytest.mark.parametrize("max_stretches", [16_384, 1])
@pytest.mark.parametrize("n", [1, 3, 24])
def test_edge_rows(workspace, documents, rows_of, n, max_stretches):
    docs = documents()
    assert rows_of(assign_shards(workspace, docs, n, max_stretches)) == expected(
        [tuple(r) for r in docs.collect()], n
    )


def test_many_groups_and_a_large_one(workspace, documents, rows_of):
    rng = random.Random(5)
    rows = [(i, "x" * rng.randrange(200) + str(i % 150), "en", "s", 1) for i in range(300)]
    rows += [(1000 + i, "the same text " * 9, "en", "s", 1) for i in range(100)]
    docs = documents(rows)
    for max_stretches in (16_384, 2):
        found = rows_of(assign_shards(workspace, docs, 7, max_stretches))
        assert found == expected(rows, 7)


def test_empty_table(workspace, documents):
    assert assign_shards(workspace, documents([])).count() == 0


def test_bounds_lead_to_the_greedy_cuts():
    rng = random.Random(1)
    for _ in range(300):
        sizes = [rng.choice([1, 2, 9, 400, rng.randrange(1, 30)]) for _ in range(rng.randrange(1, 200))]
        n, parts, width = rng.randrange(1, 9), 4, 1

        def stretches(wanted, width):
            found = defaultdict(list)
            for i in wanted:
                found[i // width].append(i)
            return [
                (m[0], sum(sizes[i] for i in m), 1 if len(m) == 1 else width) for m in found.values()
            ]

        while len(sizes) / width > 6:
            width *= parts
        order = Order(stretches(range(len(sizes)), width))
        while wanted := order.open_stretches(n, max(sizes)):
            width = max(order.stretches[i][2] for i in wanted)
            split = {i for i in wanted if order.stretches[i][2] == width}
            numbers = {order.stretches[i][0] // width for i in split}
            kept = [x for i, x in enumerate(order.stretches) if i not in split]
            inside = [i for i in range(len(sizes)) if i // width in numbers]
            order = Order(kept + stretches(inside, width // parts))
        assert order.cuts(n, max(sizes)) == greedy(sizes, n)
