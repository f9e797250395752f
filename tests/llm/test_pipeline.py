import os
import random
from collections import Counter

import pytest

import corpus_pipeline
from stratiscore.llm import decontaminate, oracles, queries, toxicity
from stratiscore.sources.staging import local_rows
from tests.llm.test_classifiers import sentences, training_table
from tests.llm.test_decontaminate import distance_in
from tests.llm.test_mixing import check as check_mix
from tests.llm.test_sharding import expected as expected_shards
from tests.llm.test_simhash import brute_components, plain_fingerprint
from verification.compare import connect, difference

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no test tables")


@pytest.mark.parametrize("name", sorted(oracles.sql()))
def test_equal_to_sql(spark, name):
    frame = queries.registered()[name](spark, FOLDER).toPandas()
    assert difference(frame, connect(FOLDER).execute(oracles.sql()[name]).df()) is None


@pytest.mark.parametrize("name", sorted(set(queries.registered()) - set(oracles.sql())))
def test_runs_whole(spark, name):
    frame = queries.registered()[name](spark, FOLDER)
    special = {"op2_decontamination": None, "op3_page_differencing": "pages", "op13_whitening": "embeddings"}
    whole = special.get(name, "documents")
    if whole:
        key = {"op11_bin_slack_packing": "start = 0", "op13_whitening": "component = 1"}.get(name, "true")
        assert frame.filter(key).count() == spark.read.parquet(f"{FOLDER}/{whole}.parquet").count()


def test_each_stage_keeps_columns_and_removes_what_it_names(spark, workspace):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    schema = docs.schema
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, workspace.stage(stage(spark, docs, FOLDER), name)
        if name in ("toxicity", "simhash_near_dedup", "decontamination"):
            assert docs.schema == schema
            assert docs.count() <= before.count()
            assert docs.join(before, docs.columns, "left_anti").count() == 0
        elif name == "mixing":
            assert docs.schema == schema
        else:
            assert docs.count() == before.count()
            assert {r["shard"] for r in docs.collect()} <= set(range(24))


def test_stages_run_on_edge_rows(spark, workspace, documents, table):
    for rows in (documents(), documents([])):
        docs = rows
        for name, stage in corpus_pipeline.STAGES:
            out = workspace.stage(stage(spark, docs, FOLDER), name)
            if name != "sharding":
                assert out.columns == docs.columns
            docs = out
    assert docs.count() == 0


def _contaminated(text, items):
    """Whether some whole short item is in the text, within a tenth of its characters."""
    text = decontaminate.normalized(text)
    return any(distance_in(item, text) <= len(item) // 10 for item in map(decontaminate.normalized, items))


@pytest.fixture(scope="module")
def small_corpus(spark, tmp_path_factory):
    """Documents of every kind that a stage decides on, with the tables the stages read."""
    import numpy as np

    rng, numbers = random.Random(4), np.random.default_rng(4)
    item = "which of the seven rivers carries the most water to the northern sea in a dry summer"
    plain, bad = sentences(numbers, 90, False), sentences(numbers, 40, True)
    words = (item + " severn more other text one two three four five six").split()
    plain[60:] = [f"{t} {' '.join(rng.sample(words, len(words)))}" for t in plain[60:]]  # clean words
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(plain)]
    rows += [(100 + i, t, "en", "forum", len(t)) for i, t in enumerate(bad)]
    rows += [(200 + i, plain[i], "en", "mirror", 1) for i in range(10)]  # copies
    rows += [(220, plain[3] + " more", "en", "mirror", 1), (1, plain[20] + " other text", "en", "s1", 1)]
    rows += [(230 + i, f"{plain[30 + i]} {item} {plain[40 + i]}", "en", "s2", 1) for i in range(3)]
    rows += [(240, plain[50].replace("a", "") + item.replace("seven", "severn"), "en", "s2", 1)]
    rows += [(None, "one two three four five six " + plain[60], "en", None, 1), (250, None, "en", "s0", 0)]
    rng.shuffle(rows)
    folder = str(tmp_path_factory.mktemp("corpus"))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    local_rows(spark, schema, rows).write.parquet(f"{folder}/documents.parquet")
    marks = [(i, 0) for i in range(90)] + [(100 + i, 1) for i in range(40)]
    labels = [(i, 1 - t, t) for i, t in marks]
    local_rows(spark, "doc_id long, quality int, toxic int", labels).write.parquet(f"{folder}/labels.parquet")
    local_rows(spark, "item_id long, text string", [(1, item)]).write.parquet(f"{folder}/benchmark.parquet")
    return folder, rows, [item]


def test_rows_after_each_stage_and_after_the_run(spark, workspace, small_corpus):
    """The decisions of every stage, as chained, against plain ones over its own input."""
    folder, rows, items = small_corpus
    plain = lambda df: [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in df.collect()]
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    model = toxicity.fit(docs, spark.read.parquet(f"{folder}/labels.parquet"))
    stages = dict(corpus_pipeline.STAGES)

    def after(name):
        nonlocal docs
        docs = workspace.stage(stages[name](spark, docs, folder), name)
        return docs

    want = Counter(r for r in rows if model.scores([r[1]])[0] < toxicity.CUT)
    kept = plain(after("toxicity"))
    assert Counter(kept) == want
    assert 0 < sum(100 <= (r[0] or 0) < 140 for r in rows) - sum(100 <= (r[0] or 0) < 140 for r in kept)

    groups = {}
    for row, label in zip(kept, brute_components([plain_fingerprint(r[1]) for r in kept])):
        groups.setdefault(label, []).append(row)
    before, kept = kept, plain(after("simhash_near_dedup"))
    heads = [{r for r in g if (r[0] is None, r[0] or 0) == min((r[0] is None, r[0] or 0) for r in g)} for g in groups.values()]
    assert len(kept) == len(groups) < len(before)
    assert all(sum(r in head for r in kept) == 1 for head in heads)
    assert {r[1] for r in kept if r[0] == 1} == {r[1] for r in before if r[0] == 1}  # both texts of one id

    want = Counter(r for r in kept if not _contaminated(r[1], items))
    before, kept = kept, plain(after("decontamination"))
    assert Counter(kept) == want
    assert {r[0] for r in before} - {r[0] for r in kept} == {230, 231, 232, 240}

    mixed = plain(after("mixing"))
    copies = Counter(mixed)
    assert set(copies) <= set(kept) and max(copies.values()) <= 3
    targets, _ = check_mix(kept, [])
    size = lambda t: len((t or "").split())
    for source, target in targets.items():
        taken = sum(size(r[1]) for r in mixed if r[3] == source)
        assert abs(taken - target) <= max(0.02 * target, max(size(r[1]) for r in kept if r[3] == source) / 2)

    names = ("doc_id", "size", "text_crc32", "shard", "slot")
    found = sorted(map(tuple, after("sharding").select(*names).collect()), key=lambda r: [(v is not None, v) for v in r])
    assert found == expected_shards(mixed, 24)
    run = corpus_pipeline.run(spark, folder).select(*names).collect()
    assert sorted(map(tuple, run), key=lambda r: [(v is not None, v) for v in r]) == found
