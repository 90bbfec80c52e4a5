"""The operators on embeddings and pages, on odd rows and against a plain form of themselves."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from logbraid.llm import collisions, components, main_text, neighbours, url_rules, vectors

VECTORS = "vec_id long, embedding array<float>, label int"


def cluster(random_, centre, n, spread):
    return (centre + spread * random_.standard_normal((n, len(centre)))).astype(np.float32)


def odd_vectors(spark, seed=0, noise=400):
    """Clusters of copies, equal vectors, other lengths, repeated rows and unusable vectors."""
    random_ = np.random.default_rng(seed)
    rows, n = [], 0

    def add(vector, repeat=1, label=0):
        nonlocal n
        rows.extend([(n, None if vector is None else [None if x is None else float(x) for x in vector], label)] * repeat)
        n += 1

    for _ in range(noise):
        add(random_.standard_normal(24))
    for size in (2, 2, 3, 5, 60):
        centre = random_.standard_normal(24)
        for v in cluster(random_, centre, size, 0.05):
            add(v)
    equal = random_.standard_normal(24)
    for _ in range(20):
        add(equal)
    add(3.0 * equal)
    add(rows[5][1], repeat=4)
    for v in cluster(random_, random_.standard_normal(7), 3, 0.01):
        add(v)
    for bad in (None, [], [0.0] * 24, [None] * 24, [float("nan")] * 24, [float("inf")] + [1.0] * 23):
        add(bad)
    df = spark.createDataFrame(rows, VECTORS)
    for name in ("id", "node", "n_links", "part", "vector", "rank"):
        df = df.withColumn(name, F.lit(name))
    return df, rows


def usable(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)


def plain_links(rows, threshold):
    n = len(rows)
    good = [i for i in range(n) if usable(rows[i][1])]
    unit = {i: np.array(rows[i][1], dtype=float) for i in good}
    unit = {i: v / np.linalg.norm(v) for i, v in unit.items()}
    links, forest = Counter(), components.Forest()
    for a in good:
        for b in good:
            if a < b and len(unit[a]) == len(unit[b]) and float(unit[a] @ unit[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                forest.join(a, b)
    return Counter(
        (rows[i][0], links[i], rows[forest.root(i)][0], rows[forest.root(i)][0] == rows[i][0])
        for i in range(n)
    )


@pytest.mark.parametrize("block", [2048, 16])
def test_links_equal_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "BLOCK", block)
    df, rows = odd_vectors(spark)
    got = Counter(tuple(r) for r in neighbours.link_near_duplicates(df).collect())
    assert got == plain_links(rows, 0.95)


def test_links_of_a_chain_and_of_pairs_at_the_threshold(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "BLOCK", 8)
    angle = float(np.arccos(0.95)) * 0.9
    rows = [(i, [float(np.cos(i * angle)), float(np.sin(i * angle))], 0) for i in range(18)]
    got = Counter(tuple(r) for r in neighbours.link_near_duplicates(spark.createDataFrame(rows, VECTORS)).collect())
    assert got == plain_links(rows, 0.95)


def two_families(random_, size):
    """Vectors of two families, at a cosine of 0.999 within one and 0.96 between."""
    axes = np.linalg.qr(random_.standard_normal((24, 2)))[0]
    angle = float(np.arccos(0.96))
    centres = axes[:, 0], np.cos(angle) * axes[:, 0] + np.sin(angle) * axes[:, 1]
    return np.concatenate([cluster(random_, c, size, 0.0045) for c in centres])


@pytest.mark.parametrize("block", [2048, 16])
def test_links_between_families_that_fill_their_lists(spark, monkeypatch, block):
    monkeypatch.setattr(neighbours, "AUDITED", 0)
    monkeypatch.setattr(neighbours, "BLOCK", block)
    rows = [(i, v.tolist(), 0) for i, v in enumerate(two_families(np.random.default_rng(2), 60))]
    got = Counter(tuple(r) for r in neighbours.link_near_duplicates(spark.createDataFrame(rows, VECTORS)).collect())
    assert {r[2] for r in got} == {0}
    assert got == plain_links(rows, 0.95)


def test_starts_grow_with_the_table():
    assert neighbours.starts_for(100, 0.95) == neighbours.STARTS
    agree = 1 - np.arccos(0.95) / np.pi
    for n in (10**5, 10**7, 10**9):
        together = agree ** np.log2(n / neighbours.RUN)
        assert 1 - (1 - together) ** neighbours.starts_for(n, 0.95) >= 0.98


def test_links_of_a_large_part_hide_no_missing_pairs(spark):
    random_ = np.random.default_rng(4)
    pairs = [cluster(random_, random_.standard_normal(24), 2, 0.01) for _ in range(40)]
    vectors_ = np.concatenate([cluster(random_, random_.standard_normal(24), 300, 0.01), *pairs])
    rows = [(i, 24, v.astype(float).tolist()) for i, v in enumerate(vectors_)]
    nodes = spark.createDataFrame(rows, "node long, dim int, vector array<double>")
    parts = spark.createDataFrame([(i, 0) for i in range(300)], "of long, part long")
    recall, links = neighbours.audit(nodes, parts, 0.95)
    assert recall < neighbours.AUDIT_RECALL
    assert {tuple(sorted(r)) for r in links.collect()} >= {(i, i + 1) for i in range(300, 380, 2)}


def test_a_search_that_misses_links_fails(spark, monkeypatch):
    none = spark.createDataFrame([], "node long, near long")
    monkeypatch.setattr(neighbours, "neighbour_graph", lambda *a: none.selectExpr("*", "1.0F AS sim"))
    monkeypatch.setattr(neighbours, "audit", lambda *a: (0.5, none))
    with pytest.raises(RuntimeError):
        neighbours.link_near_duplicates(spark.createDataFrame([(1, [1.0], 0)], VECTORS))


def test_no_vectors_give_no_links(spark):
    none = spark.createDataFrame([], VECTORS)
    assert neighbours.link_near_duplicates(none).count() == 0
    only_bad = spark.createDataFrame([(1, None, 0), (2, [0.0], 0)], VECTORS)
    got = {tuple(r) for r in neighbours.link_near_duplicates(only_bad).collect()}
    assert got == {(1, 0, 1, True), (2, 0, 2, True)}


def test_components_of_random_graphs(spark):
    pick = random.Random(1)
    for n, m in ((30, 20), (200, 150), (200, 400)):
        edges = [(pick.randrange(n), pick.randrange(n)) for _ in range(m)] + [(i, 0) for i in range(0, n, 7)]
        forest = components.Forest()
        for a, b in edges:
            forest.join(a, b)
        df = spark.createDataFrame(edges, "a long, b long").repartition(5)
        got = {r.node: r.root for r in components.connected_components(df).collect()}
        assert got == {x: forest.root(x) for x in forest.parent if forest.root(x) != x}
    path = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long").repartition(40)
    assert {r.root for r in components.connected_components(path).collect()} == {0}


# Nearest neighbours


def test_search_equals_brute_force_closely(spark):
    random_ = np.random.default_rng(3)
    vectors_ = random_.standard_normal((3000, 32)) * random_.uniform(0.5, 2.0, (3000, 1))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(vectors_)], "vec_id long, embedding array<double>, label int")
    out = collisions.nearest_by_inner_product(df, F.col("vec_id") % 20 == 0, 20).collect()
    asked, found = {}, 0
    for r in out:
        asked.setdefault(r.query_id, []).append(r)
    for q in range(0, 3000, 20):
        got = sorted(asked[q], key=lambda r: r["rank"])
        assert [r["rank"] for r in got] == list(range(1, 21))
        scores = [r.score for r in got]
        assert scores == sorted(scores, reverse=True)
        exact = vectors_ @ vectors_[q]
        assert all(abs(r.score - exact[r.vec_id]) < 1e-9 and r.vec_id != q for r in got)
        exact[q] = -np.inf
        found += len({r.vec_id for r in got} & set(np.argsort(-exact)[:20].tolist()))
    assert found / (20 * 150) >= 0.9


def test_search_on_odd_rows_with_fewer_candidates_than_ranks(spark):
    df, rows = odd_vectors(spark, noise=6)
    out = collisions.nearest_by_inner_product(df, F.col("vec_id") % 5 == 0, 500).collect()
    good = [(i, np.array(v, dtype=np.float32).astype(float)) for i, v, _ in rows if usable(v)]
    for q in sorted({i for i, _ in good if i % 5 == 0}):
        mine = next(v for i, v in good if i == q)
        want = sorted(
            ((-float((v * mine).sum()), i) for i, v in good if i != q and len(v) == len(mine))
        )
        got = sorted((r for r in out if r.query_id == q), key=lambda r: r["rank"])
        assert [r.vec_id for r in got] == [i for _, i in want]
        assert np.allclose([-r.score for r in got], [s for s, _ in want])
    assert {r.query_id for r in out} <= {i for i, _ in good}


def test_search_without_rows_or_queries(spark):
    none = spark.createDataFrame([], VECTORS)
    assert collisions.nearest_by_inner_product(none, F.lit(True), 3).count() == 0
    one = spark.createDataFrame([(1, [1.0], 0), (2, [2.0], 0)], VECTORS)
    assert collisions.nearest_by_inner_product(one, F.lit(False), 3).count() == 0


def test_lengths_of_extreme_vectors():
    assert np.allclose(vectors.lengths(np.array([[3e200, 4e200], [3e-200, 4e-200]])), [5e200, 5e-200])


# Pages

WEIGHTS = {"word": 3.0, "-word": -0.3, "p": -0.01, "h1": -0.01, "article": -0.01}
ARTICLE = "<h1>Title &amp; more</h1><p>First  paragraph,\n here.<p>Second &lt;one&gt; <b>bold</b> text"


@pytest.mark.parametrize(
    "around",
    [
        "<nav><ul><li><a href='/a'>Home<li><a>News</ul></nav>{}<footer>the end</footer>",
        "<header><p>Site name here</header><article>{}</article><aside><p>more of this</aside>",
        "<div class='cookie-notice'>we use cookies</div><main>{}</main><form><p>mail<input></form>",
        "<script>var a = '<p>no</p>';</script><style>p {{}}</style><!-- <p>no</p> -->{}<div id=comments><p>Nice post</div>",
        "<div>A word beside it<p>and one more</div><article>{}</article><div>and after</div>",
        "<div class='page has-sidebar sidebar-left'><div class=sidebar><p>no</div><main class='category-social'>{}</main></div>",
        "<div class='entry-header'>{}</div><ul class='menu'><li>no</ul><div role=search>no</div><p hidden>no",
        "<div class='ad'><div>buy <p>now</div> more</div>{}<section class=\"reader-comments\"><p>me too</section>",
    ],
)
def test_main_text_leaves_out_what_is_around(around):
    want = "Title & more\nFirst paragraph, here.\nSecond <one> bold text"
    html = f"<html><head><title>No</title></head><body>{around.format(ARTICLE)}</body>"
    assert main_text.main_text(html, WEIGHTS) == want


@pytest.mark.parametrize(
    "tag",
    [
        "<svg-icon>", "<math-renderer name='a'>", "<template-x></template-x>", "<script-y/>",
        "<svg/>", "<svg class=a viewBox='0 0 > 1' />", "<math/>", "<svg><path d='M0'/><text>no</text></svg>",
    ],
)
def test_main_text_goes_on_after_tags_like_those_skipped(tag):
    html = f"<article><p>one two {tag} three</p><p>four five</p><svg><text>no</text></svg><p>six</article>"
    assert main_text.main_text(html, WEIGHTS) == "one two three\nfour five\nsix"


STORY = "<p>one two three four five six seven</p><p>eight nine ten eleven twelve</p>"


@pytest.mark.parametrize(
    "page",
    [
        "<div id=content>{}</div><div class=related><article><p>a teaser</article></div>",
        "<div id=content>{}</div><div class=related><article><p>a teaser</article><article><p>more</article></div>",
        "<form method=post id=aspnetForm><article>{}</article></form>",
        "<form method=post><div>{}</div><div class=menu>no</div></form>",
        "<div class=page-with-sidebar><div>{}</div><div class=sidebar>no</div></div>",
        "<div class=sidebar-left><form><main>{}</main></form><form>search</form></div>",
        "<article>{}</article><div class=comments><p>I say that this is a very long thread of replies to it</div>",
    ],
)
def test_main_text_of_pages_whose_marks_mislead(page):
    want = "one two three four five six seven\neight nine ten eleven twelve"
    assert main_text.main_text(f"<body>{page.format(STORY)}</body>", WEIGHTS) == want


def test_an_unlabelled_story_beside_a_teaser_stays():
    html = f"<body><div id=content>{STORY}</div><nav>no</nav><article><p>a teaser</article></body>"
    assert main_text.main_text(html, WEIGHTS).startswith("one two three four five six seven\neight nine")


def test_main_text_passes_over_an_advert_inside():
    html = "<article><p>one two three four<div class=ad>buy now</div><p>five six seven eight</article>"
    assert main_text.main_text(html, WEIGHTS) == "one two three four\nfive six seven eight"


def test_the_best_run_equals_all_runs():
    pick = random.Random(0)
    for _ in range(300):
        scores = [pick.randint(-4, 4) for _ in range(pick.randint(0, 12))]
        a, b = main_text.best_run(scores)
        every = [sum(scores[i:j]) for i in range(len(scores)) for j in range(i, len(scores) + 1)]
        assert sum(scores[a:b]) == max(every, default=0)


def test_weights_follow_the_labels():
    weights = main_text.weights_from({"word": (900, 10), "-word": (0, 200), "li": (1, 90), "p": (50, 1)})
    assert weights["word"] > 0 and weights["-word"] < 0
    assert weights["li"] < weights["p"] < 0


def test_main_text_on_odd_rows(spark):
    rows = [
        (None, None, None), (1, "u", ""), (2, "u", "<p>"), (3, "u", "no tags at all"), (3, "u", "no tags at all"),
        (4, "u", "<<<< a < b <p class='x"), (5, "u", "<article>" + "<p>word</p>" * 20_000), (6, "u", "&#x1F642; &nosuch; &amp"),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    df = df.selectExpr("*", "'mine' AS row", "'mine' AS n_chars", "'mine' AS none")
    got = main_text.extract_main_text(df).collect()
    assert Counter(r.page_id for r in got) == Counter(r[0] for r in rows)
    text = {r.page_id: r.text for r in got}
    assert text[None] == text[1] == text[2] == ""
    assert text[3] == "no tags at all" and text[6] == "\U0001f642 &nosuch; &"
    assert text[5] == "\n".join(["word"] * 20_000)
    assert all(r.n_chars == len(r.text) and r.row == r.none == "mine" for r in got)
    assert main_text.extract_main_text(df.limit(0)).count() == 0


def test_articles_of_the_given_pages(spark, sf_dir):
    import html
    import re

    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    text = {r.page_id: r.text for r in main_text.extract_main_text(pages).collect()}
    for r in pages.collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
        assert text[r.page_id] == "\n".join(x for x in lines if x)


def given_pages(spark, sf_dir):
    import html
    import re

    for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect():
        inner = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = re.split(r"</?(?:p|h1)>", inner)
        lines = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in blocks)
        yield r.html, "\n".join(x for x in lines if x)


def without_marks(page):
    """The page with neither label, names nor tags that tell of boilerplate."""
    import re

    page = re.sub(r"<(/?)(?:article|nav|aside|footer|header)\b[^>]*>", r"<\1div>", page)
    return re.sub(r""" (?:class|id)=(?:"[^"]*"|'[^']*')""", "", page)


def test_the_scan_alone_finds_articles_of_pages_without_marks(spark, sf_dir, monkeypatch):
    weights = main_text.learn_weights(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    pages = [(without_marks(page), want) for page, want in given_pages(spark, sf_dir)]
    found = sum(main_text.main_text(page, weights) == want for page, want in pages)
    assert found >= 0.9 * len(pages)
    monkeypatch.setattr(main_text, "best_run", lambda scores: (0, len(list(scores))))
    assert not any(main_text.main_text(page, weights) == want for page, want in pages)


def test_articles_without_a_label_are_found_by_weights(spark, sf_dir):
    weights = main_text.learn_weights(spark.read.parquet(f"{sf_dir}/pages.parquet"))
    for page, want in given_pages(spark, sf_dir):
        page = page.replace("<article>", "<section>").replace("</article>", "</section>")
        assert main_text.main_text(page, weights) == want


@pytest.mark.parametrize(
    "page",
    [
        "<article>{}<p class='search-results'>and what was found</p></article>",
        "<main><div class='notice-board'>{}<p>and what was found</p></div></main>",
    ],
)
def test_names_an_article_may_be_about_keep_their_words(page):
    want = "one two three four five six seven\neight nine ten eleven twelve\nand what was found"
    assert main_text.main_text(f"<body>{page.format(STORY)}</body>", WEIGHTS) == want


@pytest.mark.parametrize("name", ["search-box", "notice", "cookie-notice", "login-form", "search"])
def test_names_of_boilerplate_in_an_article_lose_their_words(name):
    page = f"<article>{STORY}<div class='{name}'>no</div></article>"
    want = "one two three four five six seven\neight nine ten eleven twelve"
    assert main_text.main_text(f"<body>{page}</body>", WEIGHTS) == want


def test_words_of_elements_that_only_adverts_had_stay_if_they_are_all_or_long():
    weights = WEIGHTS | {"words in div": -1.0, "<div>": -6.0}
    assert main_text.main_text("<div>all there is</div>", weights) == "all there is"
    story = " ".join(["word"] * main_text.LONG)
    html = f"<body><div>an advert</div><div>{story}</div><div>another</div></body>"
    assert main_text.main_text(html, weights) == story


def test_elements_unknown_to_html_are_one_feature():
    found = main_text.tokens("".join(f"<x-{i}>word</x-{i}>" for i in range(2000)))
    assert len({t.feature for t in found} | {t.where for t in found}) <= 6


# Url rules


def plain_verdict(url, rules, otherwise="allow"):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        path = rest[: min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
        host = host.translate({c: c + 32 for c in range(65, 91)})
    fits = [
        (len(h + p), len(h), h + p, v)
        for h, p, v in rules
        if (not h or (host and (host == h or host.endswith("." + h)))) and path.startswith(p)
    ]
    best = max(fits, default=(0, 0, None, otherwise))
    return host, path, best[2], best[3]


def url_cases():
    pick = random.Random(6)
    labels, parts = ["com", "org", "a", "b-c", "example", "www"], ["", "/", "/a", "/ab", "/a/b", "/é", "/a/b/c"]
    urls = [
        f"{pick.choice(['http', 'HTTPS', 'x'])}://{'.'.join(pick.choices(labels, k=pick.randint(1, 4)))}"
        f"{pick.choice(parts)}{pick.choice(['', '?q=/x', '#f', '?a#b'])}"
        for _ in range(400)
    ]
    urls += [None, "", "no scheme", "://", "http://", "http:///a", "http://COM/a", "http://a.com?x://y", "http://.com./a", "a\n://b/c\nd"]
    urls += ["http://hot.example.com/a/b"] * 300
    rules = [
        (".".join(pick.choices(labels, k=pick.randint(1, 3))), pick.choice(parts), pick.choice(["allow", "block"]))
        for _ in range(40)
    ]
    rules = [next(r for r in rules if r[:2] == k) for k in dict.fromkeys(r[:2] for r in rules)]
    return urls, [url_rules.Rule(*r) for r in rules]


@pytest.mark.parametrize("parts", [1, 8, 50])
def test_verdicts_equal_every_rule_tried(spark, parts):
    urls, rules = url_cases()
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_rules.judge_urls(df, rules).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {i: plain_verdict(u, rules) for i, u in enumerate(urls)}


def test_a_rule_without_a_host_no_rules_and_no_urls(spark):
    df = spark.createDataFrame([(1, "http://a.b/x/y", "m"), (1, "http://a.b/x/y", "m"), (None, None, None)], "page_id long, url string, host string")
    rules = [url_rules.Rule("", "/x", "block"), url_rules.Rule("b", "/", "allow")]
    got = Counter(r.rule for r in url_rules.judge_urls(df, rules).collect())
    assert got == {"/x": 2, None: 1} or got == {"b/": 2, None: 1}
    assert {r.verdict for r in url_rules.judge_urls(df, [], otherwise="block").collect()} == {"block"}
    assert url_rules.judge_urls(df.limit(0), rules).count() == 0


def test_collisions_counted_by_ranks_equal_windows_gone_through():
    random_ = np.random.default_rng(5)
    points = random_.standard_normal((3000, 12))
    index = collisions.Index(points)
    lows = random_.integers(0, 3000, collisions.PROJECTIONS)
    highs = np.minimum(lows + random_.integers(0, 3001, collisions.PROJECTIONS), 3000)
    # Rows whose windows hold them, line by line, in the sorted order.
    order = np.argsort(index.points @ index.lines, axis=0, kind="stable").T
    plain = np.zeros(3000, dtype=int)
    for line, low, high in zip(order, lows, highs):
        plain[line[low:high]] += 1
    assert index._collisions(lows, highs).tolist() == plain.tolist()


def test_a_first_radius_too_small_widens(monkeypatch):
    random_ = np.random.default_rng(6)
    points = random_.standard_normal((2000, 16))
    index = collisions.Index(points)
    want = index.search(points[:40], 10)
    monkeypatch.setattr(collisions.Index, "_first_radii", lambda self, p, k: np.full(len(p), 0.01))
    recall = [
        len(set(a[np.argsort(-s)[:10]]) & set(np.argsort(-(points @ points[i]))[:10])) / 10
        for i, (a, s) in enumerate(index.search(points[:40], 10))
    ]
    assert len(want) == 40 and np.mean(recall) >= 0.9
