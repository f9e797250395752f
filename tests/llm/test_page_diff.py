import random

import pytest


from stratiscore.llm.page_diff import _place, common_lines, extract, text_lines

PAGE = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style>
<script>var t="</p><p>no";</script></head><body class="has-sidebar"><nav><ul><li>menu</ul></nav>
<header><p>site</p></header><!-- <p>no</p> --><div class="cookie-notice"><p>cookies</p></div>
<div id="ad-1">buy <b>now</b></div><article><header><h1>Head &amp; line</h1></header>
<p><b>One&nbsp;text &lt;x&gt; <i>a</i>b<br>next  line<p>Second
 <a href=#>link</a>.</p><form><input value=x>no</form><aside>no</aside><ul><li>x<li>y</ul>
<div class="comments"><article class="comment"><p>no</p></article></div><p hidden>no</p></article>
<section role="complementary">no</section><footer>&copy; no</footer></body></html>"""


def test_article_without_the_rest():
    lines, declared = text_lines(PAGE)
    assert declared and lines == ["Head & line", "One text <x> ab next line", "Second link.", "x", "y"]


@pytest.mark.parametrize("html", [None, "", "<", "<p", "&", "<b><b><b>", "</p></div>", "<!--", "\x00", "<![CDATA[x", "<script>"])
def test_broken_pages_do_not_fail(html):
    lines, declared = text_lines(html)
    assert not declared and all(lines)


@pytest.mark.parametrize("attribute", [
    "class='wrapper has-sidebar'", "class=no-sidebar", "class='page with-sidebar x'", "class=search-results",
    "id=main-with-sidebar", "class='page sidebar'", "class=social", "class=nav-wrapper", "id=menu-page",
])
def test_wrappers_keep_their_article(attribute):
    article = "<article><div class=post-header><h1>Head</h1></div><div class='entry-header x'>by</div><p>text</p>" \
        "<div class=related-posts><article>no</article></div><div class=widget><article>no</article></div>" \
        "<div class=comments-area>no</div></article>"
    page = f"<html><body><p>skip</p><div {attribute}><div>{article}</div></div></body></html>"
    assert text_lines(page) == (["Head", "by", "text"], True)


@pytest.mark.parametrize("attribute", [
    "class=cookie-notice", "id=ad-1", "class=ad-300x250", "class='x sidebar-left'", "class=related-posts", "class=comments-area",
    "id=site-header", "class=site-header-inner", "role=navigation", "class=main-menu", "id=div-gpt-ad-12-0", "class=share-buttons",
])
def test_elements_beside_the_text_are_dropped(attribute):
    assert text_lines(f"<div>text</div><div {attribute}>no<p>no</p></div>") == (["text"], False)


def test_articles_of_others_are_not_rescued():
    for attribute in ("class=related", "class=comments", "role=complementary", "hidden", "class=sidebar"):
        page = f"<p>a text of the page itself</p><div {attribute}><article><p>teaser</p></article></div>"
        assert text_lines(page) == (["a text of the page itself"], False)
    assert text_lines("<aside><main>no</main></aside>") == ([], False)
    assert text_lines("<div class=sidebar><article>other</article></div><article>own</article>") == (["own"], True)


def test_titles_and_states_without_a_declared_article():
    page = "<div class='wrapper has-sidebar'><div class=post-header>Head</div>text</div><div class=header>no</div>"
    assert text_lines(page) == (["Head", "text"], False)


def test_pages_without_article_keep_all_blocks():
    assert text_lines("<div>a<div>b</div>c</div>d") == (["a", "b", "c", "d"], False)


def lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@pytest.mark.parametrize("in_memory", [1 << 29, 4])
def test_longest_common_subsequence(in_memory):
    rng = random.Random(4)
    for _ in range(400):
        a = [rng.randrange(4) for _ in range(rng.randrange(14))]
        b = [rng.randrange(4) for _ in range(rng.randrange(14))]
        places = common_lines(a, b, in_memory)
        rest = iter(b)
        assert len(places) == lcs(a, b) and places == sorted(set(places))
        assert all(any(a[i] == y for y in rest) for i in places)


def plain(*lines):
    return "".join(f"<div>{line}</div>" for line in lines)


def test_lines_shared_with_the_nearest_page_go(workspace, table):
    pages = table(
        "page_id long, url string, html string, lines string, row long",
        (1, "http://h/a/1", plain("top", "first page has this text", "end"), "x", 1),
        (2, "http://h/a/2", plain("top", "second page has that text", "end"), "x", 1),
        (3, "http://h/a/2", plain("top", "second page has that text", "end"), "x", 1),
        (4, "http://h/z/9", plain("other", "third"), "x", 1),
        (5, "http://alone/1", plain("top", "only"), "x", 1),
        (6, None, None, None, None),
        (7, "no url [", plain("odd"), "x", 1),
        (None, "http://h/a/1", "", "x", 1),
        (8, "http://art/1", "<article><p>same</p><p>own 8</p></article>", "x", 1),
        (9, "http://art/2", "<article><p>same</p><p>own 9</p></article>", "x", 1),
        (10, "http://h/b/0", "<p>" + "long text " * 60_000 + "</p>" + plain("top"), "x", 1),
    )
    found = {r["page_id"]: r for r in extract(workspace, pages).collect()}
    assert len(found) == pages.count()
    # Pages 2 and 3 are copies, which say nothing about the template: both go by page 1.
    assert found[1]["text"] == "first page has this text"
    assert found[2]["text"] == found[3]["text"] == "second page has that text"
    assert found[4]["text"] == "other\n\nthird" and found[5]["text"] == "top\n\nonly"
    assert found[8]["text"] == "same\n\nown 8" and found[9]["text"] == "same\n\nown 9"
    assert found[6]["text"] == found[None]["text"] == "" and found[6]["n_chars"] == 0
    assert found[10]["text"].startswith("long text") and "\n" not in found[10]["text"]
    assert all(r["n_chars"] == len(r["text"]) for r in found.values())


def test_empty_table(workspace, table):
    assert extract(workspace, table("page_id long, url string, html string")).count() == 0


def test_neighbours_do_not_depend_on_partitions(spark, workspace, table):
    rows = [(i, f"http://h/{i % 7}/{i}", plain("top", f"text {i}", f"s{i % 3}")) for i in range(60)]
    pages = table("page_id long, url string, html string", *rows)
    one = sorted(map(tuple, extract(workspace, pages).collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "17")
    try:
        assert sorted(map(tuple, extract(workspace, pages.repartition(5)).collect())) == one
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)




MENU = [f"menu entry number {i}" for i in range(12)]


def story(i, *more):
    return plain(*MENU, f"Story {i} is short.", *more, "the footer")


def test_long_templates_go_and_short_stories_stay(workspace, table):
    rows = [(i, f"http://h/news/{i}", story(i)) for i in range(6)]
    pages = table("page_id long, url string, html string", *rows)
    found = {r["page_id"]: r["text"] for r in extract(workspace, pages).collect()}
    assert found == {i: f"Story {i} is short." for i in range(6)}


def test_copies_in_a_row_lose_their_template(workspace, table):
    rows = [(i, f"http://h/news/{i}", story(7 if 1 <= i <= 3 else i)) for i in range(6)]
    pages = table("page_id long, url string, html string", *rows)
    found = {r["page_id"]: r["text"] for r in extract(workspace, pages).collect()}
    assert found == {i: f"Story {7 if 1 <= i <= 3 else i} is short." for i in range(6)}


def test_paragraphs_shared_with_one_side_stay(workspace, table):
    quote = {1: ["a long quote that two articles share"], 2: ["a long quote that two articles share"]}
    rows = [(i, f"http://h/news/{i}", story(i, *quote.get(i, []))) for i in range(5)]
    rows += [(5, "http://other/a", plain("x", "y")), (6, "http://other/a", plain("x", "y"))]
    pages = table("page_id long, url string, html string", *rows)
    found = {r["page_id"]: r["text"].split("\n\n") for r in extract(workspace, pages).collect()}
    assert found == {i: [f"Story {i} is short.", *quote.get(i, [])] for i in range(5)} | {5: ["x", "y"], 6: ["x", "y"]}


def longest_common(a, b):
    """Places in a of one longest common subsequence, by the plain table."""
    size = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in reversed(range(len(a))):
        for j in reversed(range(len(b))):
            size[i][j] = size[i + 1][j + 1] + 1 if a[i] == b[j] else max(size[i + 1][j], size[i][j + 1])
    return size[0][0]


def test_the_whole_query_against_plain_differencing(workspace, table):
    """Texts of distinct lines, where the longest common subsequence is unique."""
    rng = random.Random(11)
    rows = []
    for i in range(150):
        host, section = rng.choice("pqr"), rng.choice(["a", "b", "b/c"])
        lines = [f"{host} top", f"{section} head"] if rng.random() < 0.9 else []
        lines += [f"line {rng.randrange(400)} of {host}" for _ in range(rng.randrange(5))]
        lines = list(dict.fromkeys([*lines, f"{host} end"]))
        html = plain(*lines)
        if rng.random() < 0.1:
            html = "<article>" + html + "</article>"
        rows.append((i, f"http://{host}/{section}/{rng.randrange(60)}", html))
    rows += [(200 + i, *rows[i][1:]) for i in range(20)]
    pages = table("page_id long, url string, html string", *rows)

    open_pages = {}
    for page_id, url, html in rows:
        lines, declared = text_lines(html)
        if lines and not declared:
            host, path = _place(url)
            firsts = open_pages.setdefault(host, {})
            key = (path, url, page_id)
            firsts[tuple(lines)] = min(key, firsts.get(tuple(lines), key))
    expected = {}
    for page_id, url, html in rows:
        lines, declared = text_lines(html)
        gone = set()
        if lines and not declared:
            host, _ = _place(url)
            order = sorted((key, texts) for texts, key in open_pages[host].items())
            at = [texts for _, texts in order].index(tuple(lines))
            path = order[at][0][0]
            near = []
            for other in (at - 1, at + 1):
                if 0 <= other < len(order):
                    folders = [x.split("/")[:-1] for x in (path, order[other][0][0])]
                    same = 0
                    while same < min(map(len, folders)) and folders[0][same] == folders[1][same]:
                        same += 1
                    near.append((same, order[other][1]))
            sides = [set(common_lines(lines, list(t))) for n, t in near if n == max(near)[0]]
            assert all(len(s) == longest_common(lines, list(t)) for s, (n, t) in zip(sides, [x for x in near if x[0] == max(near)[0]]))
            sides = [s for s in sides if s]
            gone = set.intersection(*sides) if sides else set()
        expected[page_id] = "\n\n".join(x for i, x in enumerate(lines) if i not in gone)
    found = {r["page_id"]: r["text"] for r in extract(workspace, pages).collect()}
    assert found == expected
    assert sum(len(t) for t in found.values()) < sum(len("\n\n".join(text_lines(h)[0])) for *_, h in rows)


def declared(*lines):
    return f"<div>outside</div><article>{plain(*lines)}</article>"


def texts(workspace, table, rows):
    pages = table("page_id long, url string, html string", *rows)
    return {r["page_id"]: r["text"].split("\n\n") for r in extract(workspace, pages).collect()}


def test_declared_articles_are_differenced(workspace, table):
    own = {i: [f"Story {i} is short.", *(["a quote of three"] if i in (1, 2, 3) else []), f"Its end {i}."] for i in range(20)}
    rows = [(i, f"http://h/news/{i:02}", declared("Follow us", *own[i], "Share this")) for i in own]
    # Copies count once; pages without a declared article have neighbours of their own.
    rows += [(20, "http://h/news/02", rows[2][2]), (21, "http://h/news/02b", plain("Follow us", "open"))]
    assert texts(workspace, table, rows) == own | {20: own[2], 21: ["Follow us", "open"]}


def test_declared_articles_keep_what_one_page_of_the_host_lacks(workspace, table):
    lines = {i: ["Follow us", f"Story {i} is short."] for i in range(25)} | {25: ["Story of its own."]}
    rows = [(i, f"http://h/news/{i}", declared(*lines[i])) for i in lines]
    assert texts(workspace, table, rows) == lines


def test_few_declared_articles_and_near_copies_keep_all(workspace, table):
    few = [(i, f"http://few/{i}", declared("Follow us", f"Story {i} is short.")) for i in range(19)]
    few += [(30 + i, "http://few/0", few[0][2]) for i in range(5)]
    near = [(40 + i, f"http://near/{i}", declared("Head", f"no {i}", "a long text of all")) for i in range(25)]
    rows = few + near
    assert texts(workspace, table, rows) == {i: text_lines(html)[0] for i, _, html in rows}
