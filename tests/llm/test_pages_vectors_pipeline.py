"""Operators on pages and vectors, and the pipeline, against brute-force versions."""

import math
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rillhouse.llm import (
    common, entries, html_text, language_id, suffix_dedup, top_k, url_filter, vectors,
)

# ------------------------------------------------------------------ main text


def page(nav, body, footer, extra=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>"
            f"<div class='top'>{nav}</div>{extra}{body}<div>{footer}</div></body></html>")


def test_main_text_of_marked_pages(spark):
    html = ("<html><head><title>x</title><script>var a='</p>';</script></head><body><nav><ul><li>Menu</ul></nav>"
            "<!-- <p>no</p> --><div class='ad'>Buy</div><header>Head</header><article><h1>One &amp; two</h1>"
            "<p><b>A\n  b<br>c<p>D&nbsp;&#233;<div class='comments'><p>first!</p></div><aside>side</aside>"
            "<form>name</form><ul><li>x<li>y</ul></article><footer>&copy; me")
    rows = [(1, "http://a.net/x", html), (2, None, None), (3, "nohost", ""), (4, "http://a.net/y", "<p>only")]
    found = {r.page_id: r for r in html_text.main_text(spark.createDataFrame(
        [(*r, "t") for r in rows], "page_id bigint, url string, html string, tree string")).collect()}
    assert found[1].text == "One & two\nA b c\nD é\nx\ny" and found[1].n_chars == len(found[1].text)
    assert found[2].text == "" and found[2].n_chars == 0 and found[3].text == "" and found[4].text == "only"


def test_wrapper_is_induced_without_article(spark):
    rng = random.Random(1)
    words = [f"w{i}" for i in range(60)]
    rows, want = [], {}
    for i in range(12):
        text = [" ".join(rng.choices(words, k=12)) for _ in range(rng.randint(2, 6))]
        rows.append((i, "http://site.org/a", page("Home News About", "".join(f"<p>{t}</p>" for t in text), "All rights")))
        want[i] = "\n".join(text)
    found = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r.page_id: r.text for r in found.collect()} == want


def test_copies_do_not_become_template(spark):
    rows = [(i, "http://copy.org/", page("Home", "<p>Same text</p><p>again here</p>", "End")) for i in range(9)]
    found = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    assert {r.text for r in found.collect()} == {"Home\nSame text\nagain here\nEnd"}


def test_given_pages_have_the_article(spark):
    """Brute force on the one layout of the given pages: title and paragraphs of the article."""
    import html

    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in html_text.main_text(rows).collect()}
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", inner)]
        assert found[r.page_id] == "\n".join(x for x in parts if x)


def brute_match(a, b):
    """Size of the maximum top-down matching, leaves and nodes counted."""
    if isinstance(a, int) or isinstance(b, int):
        return int(isinstance(a, int) and isinstance(b, int))
    if a[0] != b[0]:
        return 0
    m = [[0] * (len(b[1]) + 1) for _ in range(len(a[1]) + 1)]
    for i, x in enumerate(a[1], 1):
        for j, y in enumerate(b[1], 1):
            m[i][j] = max(m[i - 1][j], m[i][j - 1], m[i - 1][j - 1] + brute_match(x, y))
    return m[-1][-1] + 1


def test_tree_matching_keeps_order():
    rng = random.Random(5)

    def tree(depth, number):
        if depth == 0 or rng.random() < 0.3:
            number[0] += 1
            return number[0]
        return [rng.choice("ab"), [tree(depth - 1, number) for _ in range(rng.randint(0, 4))]]

    for _ in range(60):
        a, b = (["r", [tree(3, n) for _ in range(4)]] for n in ([0], [0]))
        pairs = html_text.match(a, b)
        assert len({x for x, _ in pairs}) == len({y for _, y in pairs}) == len(pairs)
        assert sorted(pairs) == sorted(pairs, key=lambda p: p[1])
        shapes = html_text._Shapes()
        assert shapes.score(shapes.of(a, {}), shapes.of(b, {})) == brute_match(a, b)
        assert len(pairs) <= brute_match(a, b)


def texts_of(spark, rows):
    found = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string"))
    return {r.page_id: r.text for r in found.collect()}


@pytest.mark.parametrize("html, want", [
    ('<div class="layout has-sidebar"><article><p>One</p></article></div>', "One"),
    ('<div class="with-menu"><article><p>One</p></article></div>', "One"),
    ('<div id="page-no-sidebar"><article><p>One</p></article></div>', "One"),
    ('<div class="main social-science"><article><p>One</p></article></div>', "One"),
    ('<form action="/"><article><p>One</p></article></form>', "One"),
    ('<div class="sidebar"><article><p>One</p></article></div>', "One"),
    ('<article><section id="related-work"><p>One</p></section></article>', "One"),
    ('<article><p>One <math><mi>x</mi></math></p><noscript>Two</noscript></article>', "One x\nTwo"),
    ('<article><p>The whole long text</p><article><p>A reader says</p></article></article>', "The whole long text"),
    ('<article><p>The whole long text of it</p></article><article><p>Teaser</p></article>', "The whole long text of it"),
    ('<article><p>Text</p><div class="comments"><article><p>Reader</p></article></div></article>', "Text"),
    ('<div class="comments"><article><p>Reader</p></article></div><p>Text</p>', "Text"),
    ('<div class="main-menu">Menu</div><div class="share-buttons">Share</div><p>Text</p>', "Text"),
    ('<article><header><h1>Title</h1></header><p>Text</p><footer>By</footer></article>', "Title\nText"),
])
def test_articles_and_wrappers(spark, html, want):
    assert "\n".join(x.text for x in html_text.content_leaves(html)) == want


def varied(rng, n):
    return " ".join(f"w{rng.randrange(400)}" for _ in range(n))


def test_host_with_more_template_than_article(spark):
    rng = random.Random(2)
    menu = "".join(f"<p>Entry {i} of the menu</p>" for i in range(9))
    rows, want = [], {}
    for i in range(40):
        title, body = varied(rng, 4), varied(rng, 30)
        rows.append((i, "http://heavy.org/", f"<body><div>{menu}</div><h2>{title}</h2><p>{body}</p></body>"))
        want[i] = f"{title}\n{body}"
    assert texts_of(spark, rows) == want


def test_two_layouts_and_reposted_articles(spark):
    """Templates of both layouts are learned; the article that is posted again with another
    date is no template."""
    rng = random.Random(3)
    rows, want = [], {}
    for i in range(30):
        body = varied(rng, 40)
        html = (f"<body><div><p>Old menu</p></div><p>{body}</p></body>" if i % 2 else
                f"<body><section><ul><li>New menu</li></ul></section><div><div><p>{body}</p></div></div></body>")
        rows.append((i, "http://two.org/", html))
        want[i] = body
    again = varied(rng, 60)
    for i in range(100, 120):
        rows.append((i, "http://again.org/", f"<body><p>Date {i}</p><p>{again}</p></body>"))
        want[i] = f"Date {i}\n{again}"
    assert texts_of(spark, rows) == want


def test_deep_wide_and_long_pages(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(0, "http://deep.org/", "<div>" * 10_000 + "deep" + "</section>" * 10_000 + "</div>" * 10_000),
            (1, "http://deep.org/", "<div>" * 3000 + "<p>other" * 50), (2, "http://deep.org/", "<b>" * 50_000 + "x"),
            (3, "http://long.org/", "<p>" + "word " * 400_000 + "</p>")]
    for i in range(4, 8):
        items = "".join(f"<li><a>{varied(rng, 2)}</a>" if rng.random() < .5 else f"<li>{varied(rng, 2)}" for _ in range(5000))
        rows.append((i, "http://wide.org/", f"<ul>{items}</ul>"))
    found = texts_of(spark, rows)
    assert found[0] == "deep" and found[1].endswith("other") and found[2] == "x"
    assert found[3] == ("word " * 400_000).strip() and found[4].count("\n") > 3500


def test_long_lists_are_aligned_far_from_the_diagonal(monkeypatch):
    """Equal parts at other ends of two lists are paired, however long the lists are and however
    few scores are remembered."""
    many = {t: lambda at, n, t=t: [[t, [at + i]] for i in range(n)] for t in ("p", "ul", "ol")}
    a = ["#", [["div", many["p"](0, 100) + many["ul"](100, 250)]]]
    b = ["#", [["div", many["ol"](0, 250) + many["p"](250, 100)]]]
    assert html_text.match(a, b) == [(i, 250 + i) for i in range(100)]
    rng = random.Random(7)
    for size in (9, 40):
        a, b = (["r", [[rng.choice("ab"), [[rng.choice("cd"), [0] * rng.randint(0, 2)] for _ in range(rng.randint(0, 3))]]
                       for _ in range(size)]] for _ in range(2))
        shapes = html_text._Shapes()
        assert shapes.score(shapes.of(a, {}), shapes.of(b, {})) == brute_match(a, b)
        pairs = html_text.match(a, b)
        monkeypatch.setattr(html_text, "REMEMBERED", 2)
        monkeypatch.setattr(html_text, "HELD", 0)
        assert html_text.match(a, b) == pairs
        monkeypatch.undo()


def test_depth_does_not_change_what_is_found(spark):
    """A menu's entry is template, the same words in a paragraph are not, at any depth."""
    rng = random.Random(8)
    for depth in (3, 70, 2000):
        rows, want = [], {}
        for i in range(8):
            body = varied(rng, 30) + ("</p><p>Entry" if i == 5 else "")
            rows.append((i, "http://deep.org/", "<div>" * depth + f"<ul><li>Entry</li></ul><p>{body}</p>" + "</div>" * depth))
            want[i] = body.replace("</p><p>", "\n")
        assert texts_of(spark, rows) == want


def test_large_hosts_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(html_text, "HOST_PAGES", 5)
    rng = random.Random(6)
    rows, want = [], {}
    for i in range(33):
        body = varied(rng, 20)
        host = "http://big.org/" if i < 25 else f"http://small{i % 2}.org/"
        rows.append((i, host, f"<body><div>Menu of it</div><p>{body}</p></body>"))
        want[i] = body
    rows += [(None, None, "<p>no url</p>"), (1, "http://big.org/", rows[1][2])]
    found = html_text.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")
                                .withColumn("host", F.lit("x")).withColumn("salt", F.lit(1)).withColumn("parts", F.lit("y")))
    got = sorted(((r.page_id, r.text) for r in found.collect()), key=repr)
    assert got == sorted([*want.items(), (None, "no url"), (1, want[1])], key=repr)


# ------------------------------------------------------------------ urls

RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
URLS = ["http://a.net/", "https://B.Example.NET/en/1?x", "http://example.net", "x://example.com/de/1#a", "no url", None, "",
        "http://notexample.com/de/", "http://a.b.org/fr/", "http://org/fr/x", "http://example.com?/de/", "a://b://c.net/",
        "http://net/x", "http://user@h.net:80/p", "http:///net/", "http://x.net/en/"]


def brute_url(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host):])[0]
        host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [r for r in RULES for h, p in [r.split("/", 1)]
           if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    rule = max(fit, key=len, default=None)
    return host, path, rule, RULES.get(rule, "allow")


def test_urls_against_brute_force(spark):
    rows = [(i, u, "h") for i, u in enumerate(URLS)] + [(None, URLS[0], "h")]
    df = spark.createDataFrame(rows, "page_id bigint, url string, key string")
    found = url_filter.filter_urls(df, entries.BLOCK, entries.ALLOW).collect()
    want = [(i, *brute_url(u)) for i, u, _ in rows]
    assert sorted((tuple(r) for r in found), key=repr) == sorted(want, key=repr)
    assert url_filter.filter_urls(df, [], []).filter("verdict <> 'allow'").count() == 0
    assert url_filter.filter_urls(df.limit(0), entries.BLOCK, entries.ALLOW).count() == 0


def test_cascade_is_exact_over_its_universe(spark):
    keys = [f"host{i}.net/" for i in range(4000)]
    listed = keys[::7]
    universe = spark.createDataFrame([(k,) for k in keys], "key string")
    made = url_filter.build_cascade(listed, universe, first_rate=0.3)
    assert len(made.levels) > 2
    assert [k for k in keys if k in made] == listed


# ------------------------------------------------------------------ top-k

def brute_top(rows, k=5):
    vectors = []
    for i, (vec_id, e) in enumerate(rows):
        if e is not None and all(x is not None and math.isfinite(x) for x in e):
            vectors.append((i, vec_id, [math.floor(256 * x) if abs(x) < 2.0 ** 40 else int(x) * 256 for x in e]))
    out = []
    for i, q, a in vectors:
        if q is None or q % 50:
            continue
        scored = sorted((-sum(x * y for x, y in zip(a, b)), v is None, v or 0) for j, v, b in vectors if j != i)
        out += [(q, r, None if n else v, max(min(-s, 2 ** 63 - 1), -2 ** 63)) for r, (s, n, v) in enumerate(scored[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block", [60, 1 << 20])
def test_top_k_against_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(vectors, "BLOCK_COMPONENTS", block)
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(6)]) for i in range(260)]
    rows += [(i, [0.5] * 6) for i in range(300, 310)] + [(None, [0.5] * 6), (400, None), (401, [None] * 6),
             (402, [float("nan")] * 6), (403, [float("inf")] + [0.0] * 5), (404, []), (450, [1.0, 2.0]), (50, rows[50][1])]
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id bigint, embedding array<double>, rid int, q int")
    found = top_k.top_k(df, F.col("vec_id") % 50 == 0)
    assert sorted((tuple(r) for r in found.collect()), key=repr) == brute_top(rows)


def test_top_k_of_large_components(spark):
    """Finite components of any size take part, and are compared exactly."""
    rows = [(50, [1e17, 0.]), (1, [1e17, 1.]), (2, [1.0000000000000002e17, 0.]), (3, [-1e300, 5.]), (100, [1e300, -1e300]),
            (4, [0., 1e-300]), (5, [3e38, 3e38]), (150, [0., 0.]), (6, [2.0 ** 54, 2.0 ** 60])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = sorted((tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 50 == 0).collect()), key=repr)
    assert found == brute_top(rows)


def test_collected_entries_are_all_that_reach_the_cutoff():
    import numpy as np

    rng = np.random.default_rng(1)
    for high in (130, 2 ** 20, 2 ** 40):
        q, c = rng.integers(-high, high, (20, 17)), rng.integers(-high, high, (300, 17))
        c[::3] //= 60  # too short to reach a threshold: their lists are not read
        full = q.astype(object) @ c.T.astype(object)
        for cuts in ([None if i % 5 == 4 else int(np.sort(full[i])[-6]) for i in range(20)],
                     [int(np.sort(full[i])[-1]) for i in range(20)], [-10 ** 30] * 20, [10 ** 30] * 20):
            rows, cols, scores = top_k.collected(top_k._Lists(q, c), cuts)
            assert dict(zip(zip(rows.tolist(), cols.tolist()), scores.tolist())) == {
                (i, j): full[i, j] for i in range(20) for j in range(300) if cuts[i] is None or full[i, j] >= cuts[i]}


def test_top_k_with_few_rows(spark):
    df = spark.createDataFrame([(50, [1.0]), (2, [2.0]), (3, [-3.0])], "vec_id bigint, embedding array<double>")
    found = sorted(tuple(r) for r in top_k.top_k(df, F.col("vec_id") % 50 == 0).collect())
    assert found == [(50, 1, 2, 131072), (50, 2, 3, -196608)]
    assert top_k.top_k(df.limit(0), F.col("vec_id") % 50 == 0).count() == 0


# ------------------------------------------------------------------ pipeline

def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()


def brute_near(rows):
    """Ids that stay: the smallest one of each group that similarities of 0.8 link."""
    sets = [shingles(r.text) for r in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if a and 5 * len(a & sets[j]) >= 4 * len(a | sets[j]):
                root[top(i)] = top(j)
    groups = {}
    for i, r in enumerate(rows):
        groups.setdefault(top(i), []).append((r.doc_id is None, r.doc_id))
    return sorted(min(g) for g in groups.values())


def brute_passages(rows, n=51):
    """Texts as words without repeated passages."""
    seen, gone = {}, set()
    words = {r.doc_id: suffix_dedup.WORD.findall(r.text) for r in rows}
    for d, w in words.items():
        for i in range(len(w) - n + 1):
            seen.setdefault(tuple(w[i:i + n]), []).append((d, i))
    for places in seen.values():
        if len(places) > 1:
            gone |= {(d, j) for d, i in places for j in range(i, i + n)}
    return {d: [x for j, x in enumerate(w) if (d, j) not in gone] for d, w in words.items()}


def test_pipeline_stages(spark):
    """Each stage against a brute-force version over what the one before it kept."""
    sf_dir = "/root/testdata/sf0.001"
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    passage = " ".join(f"word{i}" for i in range(60))
    extra = spark.createDataFrame(
        [(9001, "12 34", "en", "s", 5), (9002, None, None, None, None), (None, "words here", "en", "s", 10),
         (9003, "½ ² ①", "en", "s", 5), (9004, " ".join(f"before{i}" for i in range(40)) + " " + passage, "en", "s", 1),
         (9005, passage + " " + " ".join(f"after{i}" for i in range(40)), "en", "s", 1),
         (9006, " ".join(f"near{i}" for i in range(80)), "en", "s", 1),
         (9007, " ".join(f"near{i}" for i in range(78)), "en", "s", 1)], rows.schema)
    docs = rows.unionByName(rows.limit(5)).unionByName(extra)
    kept, given = {}, {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, common.stored(stage(spark, docs, sf_dir), "test-stage")
        given[name], kept[name] = before.collect(), docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    ids = [r.doc_id for r in kept["language_id"]]
    assert not {9001, 9002, 9003} & set(ids) and None in ids and len(ids) == rows.count() + 5 + 5

    def plain(r):
        return re.sub("[\x20\x09-\x0d]", "", r.text or "")

    best = {}
    for r in given["exact_dedup"]:
        best[plain(r)] = min(best.get(plain(r), (1, True, 0)), (-len(r.text), r.doc_id is None, r.doc_id or 0))
    assert sorted((-len(r.text), r.doc_id is None, r.doc_id or 0) for r in kept["exact_dedup"]) == sorted(best.values())
    near = brute_near(given["simhash_near_dedup"])
    assert sorted((r.doc_id is None, r.doc_id) for r in kept["simhash_near_dedup"]) == near
    assert 9006 in {d for _, d in near} and 9007 not in {d for _, d in near}
    cut = {r.doc_id: suffix_dedup.WORD.findall(r.text) for r in kept["suffix_array_dedup"]}
    want = brute_passages(given["suffix_array_dedup"])
    assert cut == want and not any("word5" in w for w in want.values())
    assert sum(map(len, want.values())) < sum(len(suffix_dedup.WORD.findall(r.text)) for r in given["suffix_array_dedup"])
    assert {r.doc_id for r in kept["best_fit_packing"]} == set(cut)
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "language_id", "exact_dedup", "simhash_near_dedup", "suffix_array_dedup", "best_fit_packing"]


def test_pipeline_run_and_clashing_columns(spark, tmp_path):
    """run() leaves only its result behind, and columns named like the library's own stay."""
    from pathlib import Path

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    written = len(common._folders)
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert packed.count() > 0
    left = [f for f in common._folders[written:] if Path(f.removeprefix("file:")).exists()]
    assert [f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in left] == ["pipeline-best_fit_packing"]
    for name in ("_language", "judged", "_keep_doc", "row", "sha", "less", "found", "k1", "node"):
        docs = docs.withColumn(name, F.lit(name))
    rows = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = common.stored(stage(spark, rows, ""), "clash")
    assert rows.columns == docs.columns
    assert all(r[c] == c for r in rows.collect() for c in docs.columns[5:])


def test_letters_are_letters_only():
    for text in ("²", "½", "①", "Ⅷ", "_", "12", ""):
        assert not language_id._LETTER.search(text)
    for text in ("a", "é", "ß", "日", "ʰ", "ǅ"):
        assert language_id._LETTER.search(text)


def test_hosts_of_very_many_labels():
    keys = url_filter.candidate_keys(".".join(["a"] * 100_000), "/de/x", [1, 4], 2)
    assert keys == ["a.a/de/", "a/de/", "a.a/", "a/"]
