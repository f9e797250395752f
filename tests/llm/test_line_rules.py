import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pytest

from stratiscore.llm import oracles
from stratiscore.llm.line_rules import apply_rules, remove_lines
from verification.compare import difference

WORDS = r"[^\x20\x09-\x0D]+"


def base(text):
    text = text or ""
    words = re.findall(WORDS, text)
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    repeated = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 3)}
    lines = [x for x in text.split("\n") if re.search(WORDS, x)]
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)),
            len(repeated), n < 50 or 100 * len(repeated) > 50 * n)


NAMES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_base_counts_against_brute_force(workspace, documents):
    rng = random.Random(8)
    texts = ["".join(rng.choice("ab #|\n\t\x0b1é") for _ in range(rng.randrange(300))) for _ in range(80)]
    rows = [(i, t, "en", "s", 1) for i, t in enumerate([*texts, None, "", "a b a b a b", "x y z x y z"])]
    found = {r["doc_id"]: r for r in apply_rules(workspace, documents(rows)).collect()}
    for doc_id, text, *_ in rows:
        assert tuple(found[doc_id][n] for n in NAMES) == base(text)


def test_edge_rows(workspace, documents):
    docs = documents()
    found = apply_rules(workspace, docs).collect()
    assert len(found) == docs.count()
    assert not any(r["kept"] for r in found if r["base_failed"])
    assert {r["doc_id"] for r in found if r["kept"]} == {6, 7, 8, None}


def corpus():
    rng = random.Random(1)
    rows = []
    for i in range(300):
        own = " ".join(f"w{rng.randrange(10**6)}" for _ in range(60))
        shared = "Shared LINE 12 of  this host " + "and more words " * (25 if i % 3 == 0 else 1)
        host = None if i % 5 == 0 else f"h{i % 2}"
        rows.append((i, f"{own}\n{shared}" if i % 2 else f"{shared}\n\n{own}\n", "en", host, 1))
    return rows


def test_frequent_lines_go_and_depleted_documents_are_rejected(workspace, documents):
    docs = documents(corpus(), clashes=False)
    found = apply_rules(workspace, docs).toPandas()
    assert 0 < found["kept"].sum() < len(found) and (found["n_line_words"] > 0).any()
    db = duckdb.connect()
    table = docs.toArrow()
    db.register("documents", table)
    assert difference(found, db.execute(oracles.sql()["op10_line_rules"]).df()) is None


def plain(line):
    return re.sub("[0-9]", "0", " ".join(re.findall(WORDS, line)).lower())


def brute_remaining(rows):
    """Rows that stay and their texts without frequent lines, with the limits of production."""
    held, hosts = defaultdict(set), Counter()
    for i, (doc_id, text, _, host, _) in enumerate(rows):
        hosts[host] += 1
        for line in (text or "").split("\n"):
            held[host, plain(line)].add(("row", i) if doc_id is None else doc_id)
    out = []
    for doc_id, text, lang, host, n in rows:
        limit = max(20, 0.005 * hosts[host])
        gone = [bool(plain(x)) and len(held[host, plain(x)]) > limit for x in (text or "").split("\n")]
        left = "\n".join(x for x, g in zip((text or "").split("\n"), gone) if not g)
        words = sum(len(plain(x).split()) for x, g in zip((text or "").split("\n"), gone) if g)
        n_words, *_, failed = base(text)
        out.append(((doc_id, left, lang, host, n), not failed and 100 * words <= 50 * n_words))
    return out


def test_remaining_texts_against_brute_force(workspace, documents):
    rows = corpus()
    rows += [(i, *rows[i][1:]) for i in (3, 4, 4)]  # repeated rows
    rows += [(None, *rows[7][1:]), (None, *rows[8][1:]), (900, None, None, None, None), (901, "", "en", "h1", 0)]
    want = brute_remaining(rows)
    docs = documents(rows)
    kept = remove_lines(workspace, docs)
    assert kept.columns == docs.columns
    assert Counter(tuple(r)[:5] for r in kept.collect()) == Counter(r for r, stays in want if stays)
    digests = Counter((r["doc_id"], r["kept"], r["kept_sha256"]) for r in apply_rules(workspace, docs).collect())
    assert digests == Counter((r[0], stays, hashlib.sha256(r[1].encode()).hexdigest()) for r, stays in want)
    assert 0 < sum(stays for _, stays in want) < len(rows)


def test_copies_in_one_id_count_once(workspace, documents):
    text = "one line only " + " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "en", "h", 1)] * 40 + [(2, text, "en", "h", 1)]
    assert all(r["kept"] for r in apply_rules(workspace, documents(rows)).collect())


def test_no_python_runs(workspace, documents, plan_of):
    plan = plan_of(apply_rules(workspace, documents()))
    assert not re.search("Python|Arrow|Pandas", plan)
    assert not re.search("Python|Arrow|Pandas", plan_of(remove_lines(workspace, documents())))


def test_empty_table(workspace, documents):
    assert apply_rules(workspace, documents([])).count() == 0
    assert remove_lines(workspace, documents([])).count() == 0


@pytest.mark.parametrize("share, kept", [(0.0, 0), (1.0, 30)])
def test_limit_is_a_share_of_the_host(workspace, documents, share, kept):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(i, text, "en", "h", 1) for i in range(30)]
    found = apply_rules(workspace, documents(rows), host_share=share).collect()
    assert sum(r["kept"] for r in found) == kept
