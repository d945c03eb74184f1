import random

import pytest

from rigprep.llm import html_text

SCHEMA = "page_id long, url string, html string"
FRAME = "<html><head><title>t</title><style>p{}</style><script>var a='</p><p>x';</script></head><body>{top}<article><h1>A &amp; B</h1>{body}</article>{end}</body></html>"


def page(body, top="", end=""):
    return FRAME.replace("{top}", top).replace("{body}", body).replace("{end}", end)


def run(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        for c in ("row", "host", "path", "part", "mate", "kinds", "texts", "text"):
            df = df.withColumn(c, df.page_id.cast("string"))
    return {r.page_id: r for r in html_text.main_text(df).collect()}


@pytest.mark.parametrize("extra", [False, True])
def test_marked_frame_goes_and_blocks_are_joined(spark, extra):
    top = "<nav><ul><li><a href='/x'>Menu</a></li></ul></nav><div class=\"ad\">Buy</div><div id=cookie-notice>Cookies</div><div hidden>no</div>"
    body = "<p>one\n  <b>t</b>w<i>o</i><p>three &lt;3 &#233;<br>four</p><aside>side</aside><section class='comments'><p>reader says</p></section><form>f</form><ul><li>x</li><li>y</li></ul><!-- <p>gone</p> -->"
    rows = [(1, "http://h/a", page(body, top, "<footer>&copy; foot</footer>")), (2, None, None), (3, "", ""), (4, "http://h/b", "<nav>only</nav>"), (5, "x", "plain words"), (6, "y", "<article><p>cut <b>of")]
    got = run(spark, rows, extra)
    assert got[1].text == "A & B\none two\nthree <3 é\nfour\nx\ny"
    assert [got[k].text for k in (2, 3, 4, 5, 6)] == ["", "", "", "plain words", "cut of"]


def test_unmarked_lines_that_the_nearest_page_shares_go(spark):
    def plain(n):
        return f"<body><p>Site line</p><div>Second</div><p>Own words {n}</p><p>Last of site</p></body>"

    got = run(spark, [(1, "http://h/en/1", plain(1)), (2, "http://h/en/12", plain(2)), (3, "http://other/en/1", plain(3))])
    assert got[1].text == "Own words 1" and got[2].text == "Own words 2"
    assert got[3].text == "Site line\nSecond\nOwn words 3\nLast of site"  # alone on its host
    twins = run(spark, [(1, "http://h/1", page("<p>same</p>")), (2, "http://h/2", page("<p>same</p>"))])
    assert twins[1].text == twins[2].text == "A & B\nsame"  # articles are never frame


def test_longest_common_subsequence_equals_dynamic_programming():
    r = random.Random(0)
    for _ in range(200):
        a, b = ([r.choice("abcd") for _ in range(r.randint(0, 9))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        got = sorted(html_text.common_lines(a, b))
        it = iter(b)
        assert len(got) == best[-1][-1] and all(a[i] in it for i in got)


def test_neighbours_by_path(spark):
    urls = ["http://a/x/1", "http://a/x/15", "http://a/x/2", "https://A/y", "http://b/x/1", None]
    df = spark.createDataFrame(list(enumerate(urls)), "row long, url string")
    assert {r.row: r.mate for r in html_text.nearest(df).collect()} == {0: 1, 1: 0, 2: 1, 3: 2, 4: None, 5: None}


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_copies_keep_their_text_and_class_names_inside_an_article_do_not_count(spark):
    twin = "<body><p>One line of a page.</p><p>Another line of it.</p></body>"
    art = "<article><div class='related work'>A</div><p class='share price'>B</p><section id='search-methods'>C</section><math><mi>x</mi></math><div class='comments'>no</div></article>"
    rows = [(1, "http://h.org/a", twin), (2, "http://h.org/b", twin), (3, "http://h.org/b", twin), (4, "http://g.org/", art), (5, "http://k.org/x", twin), (5, "http://k.org/x", twin)]
    got = html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.text) for r in got) == sorted((p, "A\nB\nC\nx" if p == 4 else "One line of a page.\nAnother line of it.") for p, _, _ in rows)


def test_common_lines_are_a_longest_common_subsequence():
    import random

    def length(a, b):
        best = [0] * (len(b) + 1)
        for x in a:
            before = 0
            for j, y in enumerate(b):
                before, best[j + 1] = best[j + 1], before + 1 if x == y else max(best[j], best[j + 1])
        return best[-1]

    r = random.Random(1)
    for _ in range(500):
        a, b = ([r.choice("abcd") for _ in range(r.randint(0, 30))] for _ in "ab")
        found = html_text.common_lines(a, b)
        rest = iter(b)
        assert len(found) == length(a, b) and all(any(y == a[i] for y in rest) for i in sorted(found))


def test_hostile_pages_take_time_in_proportion():
    import time

    for page in ("<a " * 400_000 + '"', '<a "b>c" ' * 150_000 + "'", "<span>" * 150_000 + "</i>" * 150_000, "<p>" + "<span>" * 80_000 + "<div></div>" * 80_000):
        began = time.process_time()
        list(html_text.lines(page))
        assert time.process_time() - began < 10
    began = time.process_time()
    html_text.common_lines(["x"] * 20_000 + ["y"], ["x"] * 15_000 + ["z"] + ["x"] * 5_000)
    assert time.process_time() - began < 10


def test_only_classes_of_frame_words_mark_frame_outside_articles():
    page = "<p class='share price'>A</p><div class='search methods'>B</div><p class='related-work'>C</p><div class='site-footer'>no</div><div id='related-posts-2'>no</div><div class='share'>no</div>"
    assert [t for k, t in html_text.lines(page) if k == "open"] == ["A", "B", "C"] and [t for k, t in html_text.lines(page) if k == "frame"] == ["no"] * 3


def test_a_paragraph_of_two_pages_stays_and_one_of_three_goes(spark):
    shared, often = "A long paragraph that two pages of a host may well have in common without being frame, ever.", "Another long line that every page of this host carries at its end, which makes it frame, surely."
    rows = [(k, f"http://h/{k}", f"<p>own {k}</p><p>short</p>" + (f"<p>{shared}</p>" if k < 2 else "") + f"<p>{often}</p>") for k in range(4)]
    got = {r.page_id: r.text.split("\n") for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {0: ["own 0", shared], 1: ["own 1", shared], 2: ["own 2"], 3: ["own 3"]}


def test_long_urls_are_compared_by_halving(spark):
    rows = [(k, "http://h/" + "x" * 100_000 + f"/{k:02d}", f"<p>own {k}</p><p>frame</p>") for k in range(40)] + [(40, "http://h/", "<p>home</p><p>frame</p>")]
    got = {r.page_id: r.text for r in html_text.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {k: f"own {k}" for k in range(40)} | {40: "home"}


def test_the_nearest_url_has_most_leading_characters_in_common(spark):
    urls = ["http://h/a", "http://h/ab", "http://h/abc", "http://h/abd", "http://h/b", "http://g/abc", None, "http://h/\u00e9a", "http://h/\u00e9b"]
    df = spark.createDataFrame(list(enumerate(urls)), "row long, url string")
    mates = {r.row: r.mate for r in html_text.nearest(df).collect()}
    lead = lambda x, y: next((k for k, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))  # noqa: E731, B905
    order = sorted((u.split("/", 3)[3], k) for k, u in enumerate(urls) if u and "//h" in u)
    for i, (path, k) in enumerate(order):
        beside = {j: lead(path, order[j][0]) for j in (i - 1, i + 1) if 0 <= j < len(order)}
        assert mates[k] in {order[j][1] for j, n in beside.items() if n == max(beside.values())}
    assert mates[5] is None and mates[6] is None


def test_no_table_of_pages_is_broadcast(spark, monkeypatch):
    plans = []
    plan = lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString())
    keep = html_text.materialize
    monkeypatch.setattr(html_text, "materialize", lambda df, name: plan(df) or keep(df, name))
    often = "A long line that every page of this host carries at its end, which makes it frame, surely, everywhere."
    rows = [(k, f"http://h/{k}", f"<p>own {k}</p><p>frame</p><p>{often}</p>") for k in range(9)]
    found = html_text.main_text(spark.createDataFrame(rows, SCHEMA))
    plan(found)
    assert {r.page_id: r.text for r in found.collect()} == {k: f"own {k}" for k in range(9)}
    assert sum("SortMergeJoin" in p for p in plans) == 3 and not any("Broadcast" in p for p in plans)
