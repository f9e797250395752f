import re

import pytest

from stratiscore.llm.mixing import MAX_REPEAT, mix, repeat


def targets(sizes, weights=(1, 2, 3), limit=MAX_REPEAT):
    """Water filling by hand. Sources are keys of a dict, None last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, stopped = sum(sizes.values()), set()
    while True:
        left = total - sum(limit * sizes[s] for s in stopped)
        free = sum(weight[s] for s in order if s not in stopped)
        new = {s for s in order if s not in stopped and weight[s] * left / free > limit * sizes[s]} if free else set()
        if not new:
            return {
                s: limit * sizes[s] if s in stopped else weight[s] * left / free for s in order
            }
        stopped |= new


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, found):
    sizes = {}
    for _, text, _, source, *_ in rows:
        sizes[source] = sizes.get(source, 0) + size(text)
    wanted = targets(sizes)
    by_source = {}
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(wanted[r["source"]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= MAX_REPEAT
        assert r["rate"] * r["source_size"] == pytest.approx(r["target"], rel=1e-6, abs=1e-6)
        by_source.setdefault(r["source"], []).append(r)
    return wanted, by_source


def test_edge_rows(workspace, documents):
    docs = documents()
    found = mix(workspace, docs).collect()
    assert len(found) == docs.count()
    check([tuple(r) for r in docs.collect()], found)


def test_taken_words_come_near_the_targets(workspace, documents):
    rows = [
        (i, "w " * (1 + i * i % 97 + (400 if i % 50 == 0 else 0)), "en", f"s{i % 7}" if i % 3 else "big", 1)
        for i in range(1200)
    ]
    found = mix(workspace, documents(rows)).collect()
    wanted, by_source = check(rows, found)
    for source, members in by_source.items():
        assert sum(r["taken"] for r in members) == pytest.approx(wanted[source], rel=0.02)
    again = {(r["doc_id"], r["taken"]) for r in mix(workspace, documents(rows)).collect()}
    assert again == {(r["doc_id"], r["taken"]) for r in found}


def test_scarce_sources_stop_at_their_limit(workspace, documents):
    rows = [(i, "w " * 100, "en", "a", 1) for i in range(50)]
    rows += [(100 + i, "w " * 5, "en", s, 1) for i, s in enumerate(["b", "c", None])]
    found = mix(workspace, documents(rows)).collect()
    check(rows, found)
    assert all(r["copies"] == 3 for r in found if r["source"] != "a")


def near(rows, found):
    wanted, by_source = check(rows, found)
    for source, members in by_source.items():
        assert sum(r["taken"] for r in members) == pytest.approx(wanted[source], rel=0.02)


@pytest.mark.parametrize("small", [3, 10_000])
def test_sources_of_null_and_repeated_ids_come_near_too(spark, documents, small):
    from stratiscore.config import Settings
    from stratiscore.sources.staging import Workspace

    rows = [(None, "w " * 5 + f"n{i}", "en", "a", 1) for i in range(100)]  # null ids
    rows += [(i // 2, f"t{i} " * 3, "en", "b", 1) for i in range(200)]  # each id on two rows
    rows += [(None, "same words all over", "en", "c", 1)] * 150  # one text, no id
    rows += [(7, "w " * 11, "en", "d", 1)] * 90 + [(i, "x " * 4, "en", "d", 1) for i in range(100)]
    rows += [(1000 + i, "y " * (i % 9 + 1), "en", None, 1) for i in range(100)]
    workspace = Workspace(spark, Settings(small_table_rows=small))
    found = mix(workspace, documents(rows)).collect()
    assert len(found) == len(rows)
    near(rows, found)
    key = lambda r: (str(r["doc_id"]), str(r["source"]), r["size"], r["taken"])
    again = mix(workspace, documents(rows).repartition(7), with_rows=True).collect()
    assert sorted(map(key, again)) == sorted(map(key, found))
    assert all(r["row"]["doc_id"] == r["doc_id"] and size(r["row"]["text"]) == r["size"] for r in again)


def test_documents_are_repeated_with_their_columns(workspace, documents):
    docs = documents()
    mixed = mix(workspace, docs, with_rows=True)
    total = sum(r["copies"] for r in mixed.collect())
    out = repeat(mixed)
    assert out.schema == docs.schema and out.count() == total


def test_empty_table(workspace, documents):
    assert mix(workspace, documents([])).count() == 0
