"""Page differencing, vector operators and components against brute force."""

import random

import numpy as np
import pandas as pd

from tallyweave.llm import html_text, queries, vector_dedup, vector_search
from tallyweave.llm.components import components

NAV = '<nav><a href="/">Home</a></nav><div class="ad">Buy now</div><p>Welcome to our site</p>'


def test_lines_of_a_page():
    page = (
        "<html><head><title>T</title><script>var a='<p>no</p>';</script></head><body>" + NAV
        + "<article><header><h1>Big &amp; bold</h1></header><p>One\n  two<br>three &lt;x&gt;<p>Four</p><aside>Side</aside></article>"
        "<section id='comments'><p>Nice!</p></section><form><p>Mail</p></form><footer>&copy; us</footer>"
    )
    lines = html_text.lines_of(page)
    assert [line.text for line in lines] == ["Welcome to our site", "Big & bold", "One two three <x>", "Four"]
    assert [line.own for line in lines] == [False, True, True, True]
    assert html_text.lines_of(None) == html_text.lines_of("") == []
    assert [x.text for x in html_text.lines_of("plain <b>text")] == ["plain text"]


def test_only_real_marks_drop_an_element():
    kept = [
        '<body style="overflow:hidden">', '<main style="overflow-x: hidden">', '<a href="/hidden-gems" title="The hidden valley">', '<body class="has-sidebar">',
        '<main class="site-main has-sidebar">', '<div class="content no-comments">', '<div class="post category-social">', '<div class="post-header">',
        '<section class="related-work">', '<article class="post header">', '<main id="search">', '<div hidden="until-found">', '<div title="display:none">',
    ]
    gone = [
        "<div hidden>", '<div hidden="">', '<p style="color:red; display: none">', '<div style="visibility:hidden">', '<div class="x sidebar">', '<div role="navigation">',
        '<div class="user-comments">', '<div class="post-comments">', '<div class="related-posts">', '<div class="cookie-notice">', '<div class="article-share-buttons">',
        '<div class="site-header">', '<div id="comments_list">', '<div class="ad-300x250">', '<article hidden>', '<div class="top_nav">',
    ]
    assert [x for x in kept if [line.text for line in html_text.lines_of(x + "Text of it")] != ["Text of it"]] == []
    assert [x for x in gone if html_text.lines_of(x + "Text of it")] == []


def test_broken_quotes_leave_no_markup():
    for mark in ('<p title="5" wide">', "<p title='5' tall'>", '<p title=5">', '<p title = "a > b" x="">'):
        assert [line.text for line in html_text.lines_of(mark + 'Hello "you" of 5" and 6">')] == ['Hello "you" of 5" and 6">'], mark


def test_a_site_without_class_names(spark):
    menu = "".join(f"<div>Menu entry {k}</div>" for k in range(5))
    pages = [(k, f"http://h.org/s/{k}", f"{menu}<div>Story {k}</div><div>Imprint</div>") for k in range(40)]
    # Copies in a row are one page, and versions of a page are none to compare it with.
    pages += [(100 + k, "http://h.org/s/20", pages[20][2]) for k in range(30)]
    long = "".join(f"<div>Part {k} of the long one</div>" for k in range(20))
    pages += [(200 + k, f"http://h.org/s/30/v{k}", f"{menu}{long}<div>Version {k}</div><div>Imprint</div>") for k in range(3)]
    got = {}
    for parts in (1, 4):
        rows = html_text.main_text(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(parts))
        got[parts] = {r.page_id: r.text for r in rows.collect()}
    assert got[1] == got[4] and len(got[1]) == len(pages)
    for k, text in got[1].items():
        if k < 40:
            assert text == f"Story {k}"
        elif k < 200:
            assert text == "Story 20"
        else:
            assert text.split("\n") == [*(f"Part {j} of the long one" for j in range(20)), f"Version {k - 200}"]


def test_longest_common_subsequences():
    draw = random.Random(3)

    def brute(a, b):
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        return table[-1][-1]

    for _ in range(300):
        a, b = ([draw.choice("abcd") for _ in range(draw.randrange(12))] for _ in range(2))
        places = html_text.shared_lines(a, b)
        assert len(places) == brute(a, b)
        left = iter(b)
        assert all(a[k] in left for k in sorted(places))  # a subsequence of b


def test_shared_open_lines_go_and_own_lines_stay(spark):
    body = "<div><p>Top stories</p><p>{}</p><p>All rights reserved by us</p></div>"
    article = NAV + "<article><p>Quoted line</p><p>{}</p></article>"
    pages = [(k, f"http://h.org/p/{k}", body.format(f"Story number {k} is told here")) for k in range(1, 4)]
    pages += [(k, f"http://www.h.net/a/{k}.html", article.format(f"Body {k}")) for k in range(4, 7)]
    pages += [(7, None, body.format("alone")), (8, "http://x.org/", None), (9, "http://y.org/", body.format("only")), (9, "http://y.org/", body.format("only"))]
    df = spark.createDataFrame([(*p, "t", 1) for p in pages], "page_id long, url string, html string, text string, __host int").drop("__host")
    rows = html_text.main_text(df.repartition(1))
    assert rows.columns == ["page_id", "url", "text"]
    got = {r.page_id: r.text for r in rows.collect()}
    assert rows.count() == 10 and got[8] == ""
    assert all(got[k] == f"Quoted line\nBody {k}" for k in range(4, 7))
    assert got[2] == "Story number 2 is told here" and got[9] == "Top stories\nonly\nAll rights reserved by us"
    assert html_text.main_text(df.where("false")).count() == 0


def test_pages_keep_their_articles(found):
    rows = found("op3")
    assert all(r.n_chars == len(r.text) and r.text for r in rows)
    assert not any("&amp;amp;" in r.text or "<p>" in r.text for r in rows)


def test_components(spark):
    draw = random.Random(5)
    edges = [(draw.randrange(60), draw.randrange(60)) for _ in range(35)] + [(100 + k, 101 + k) for k in range(30)] + [(7, 7), (None, 3)]
    parent = {}

    def root(k):
        while parent.setdefault(k, k) != k:
            k = parent[k]
        return k

    for a, b in edges:
        if a is not None and a != b:
            x, y = root(a), root(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(edges, "a long, b long")
    for part_rows in (100_000, 7):
        assert {r.node: r.component for r in components(df, "a", "b", part_rows).collect()} == {k: root(k) for k in list(parent)}
    assert components(df.where("false"), "a", "b").count() == 0


def vectors(spark):
    draw = np.random.default_rng(1)
    base = draw.standard_normal((300, 16))
    near = base[:60] + 0.08 * draw.standard_normal((60, 16))
    rows = [(k, [float(x) for x in v], int(k % 3)) for k, v in enumerate(base)]
    rows += [(300 + k, [float(x) for x in v], int(k % 3)) for k, v in enumerate(near)]
    rows += [(400, rows[0][1], 0), (400, rows[0][1], 0), (401, rows[0][1], None), (402, None, 0), (403, [0.0] * 16, 0)]
    rows += [(404, [float("nan")] * 16, 0), (405, [None] + [1.0] * 15, 0), (406, [2 * x for x in rows[3][1]], 0), (407, [1.0, 2.0], 0), (408, [1.0, 2.1], 0)]
    return rows, spark.createDataFrame([(*r, 1, "x") for r in rows], "vec_id long, embedding array<float>, label int, n_links int, cid string")


def usable(rows):
    return [(k, np.array(v, np.float32).astype(float), label) for k, v, label in rows if v is not None and None not in v and np.isfinite(v).all() and any(v)]


def test_vector_links_equal_brute_force(spark):
    rows, df = vectors(spark)
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in vector_dedup.near_duplicates(df).collect())
    able = [x for x in usable(rows) if x[2] is not None]
    links = {i: {j for j, y in enumerate(able) if j != i and x[2] == y[2] and len(x[1]) == len(y[1]) and x[1] @ y[1] / np.linalg.norm(x[1]) / np.linalg.norm(y[1]) >= 0.93} for i, x in enumerate(able)}

    def reach(i):
        seen, todo = {i}, [i]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        return min(able[j][0] for j in seen)

    expected = [(x[0], len(links[i]), reach(i)) for i, x in enumerate(able)]
    expected += [(k, 0, k) for k in (401, 402, 403, 404, 405)]
    assert got == sorted((a, n, c, a == c) for a, n, c in expected)
    assert vector_dedup.near_duplicates(df.where("false")).count() == 0


def test_a_repeated_vec_id_keeps_its_unusable_row(spark):
    rows = [(1, [1.0, 2.0], 0), (1, None, 0), (1, [0.0, 0.0], 0), (1, [1.0, 2.0], None), (2, [1.0, 2.0], 0), (3, [float("nan"), 1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = sorted((r.vec_id, r.n_links) for r in vector_dedup.near_duplicates(df).collect())
    assert got == [(1, 0), (1, 0), (1, 0), (1, 1), (2, 1), (3, 0)]


def test_small_tables_answer_with_all_there_is():
    draw = np.random.default_rng(4)
    for n in range(3, 31):
        frame = pd.DataFrame({"vec_id": range(n), "embedding": list(draw.standard_normal((n, 64))), "asks": False})
        out = vector_search._answered(10, vector_search.ENOUGH)((0, 0), pd.concat([frame, frame.assign(asks=True)]))
        assert (out.groupby("query_id").size() == min(10, n - 1)).all() and out["query_id"].nunique() == n


def test_nearest_vectors(spark, sf, found):
    rows, df = vectors(spark)
    able = [x for x in usable(rows) if len(x[1]) == 16]
    for share, least in ((1e9, 1.0), (vector_search.ENOUGH, 0.8)):
        got = vector_search.nearest(df, "vec_id % 50 = 0", share=share).collect()
        hits = total = 0
        for query, vector, _ in able:
            if query % 50 or query == 400:
                continue
            best = sorted((float(np.sqrt(((v - vector) ** 2).sum())), k) for k, v, _ in able if k != query)[:10]
            mine = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == query)
            assert [r for r, _, _ in mine] == list(range(1, 11))
            hits += len({k for _, k in best} & {k for _, k, _ in mine})
            total += len({k for _, k in best})
        assert hits >= least * total
    few = {r.vec_id for r in vector_search.nearest(df, "vec_id = 407").collect()}
    assert few == {408}
    assert vector_search.nearest(df.where("false"), "true").count() == 0
    base = {r.vec_id: np.array(r.embedding, float) for r in queries.table(spark, sf, "embeddings").collect()}
    hits = 0
    for query in {r.query_id for r in found("op10")}:
        best = sorted((float(np.sqrt(((v - base[query]) ** 2).sum())), k) for k, v in base.items() if k != query)[:10]
        hits += len({k for _, k in best} & {r.vec_id for r in found("op10") if r.query_id == query})
    assert hits >= 0.9 * len(found("op10"))
