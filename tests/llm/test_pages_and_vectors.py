"""Main text, url rules and vector search."""

import itertools
import random
import re
import time

import numpy as np
import pytest

from shelfcast.llm import html_paths, url_rules, vector_forest
from shelfcast.llm.queries import QUERIES, URL_RULES
from shelfcast.llm.urls import host_of, path_of

RULES = [
    ("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
    ("net/es/", "block"), ("net/fr/", "block"),
]


def page(body):
    return (
        "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head>"
        f"<body><header><h2>Site</h2></header><nav><ul><li><a href='/'>Home</a></li></ul></nav>{body}"
        "<footer>&copy; site</footer></body></html>"
    )


CASES = [
    ("<article><h1>A &amp; B</h1><p>One\n two&nbsp;three<p>Four <b>five</b><br>six</article>", "A & B\n\nOne two three\n\nFour five six"),
    ("<div class='ad'>Buy</div><article><p>Text<!-- no --> here</p></article>", "Text here"),
    ("<article><p>a</p><div class='cookie-notice'>Cookies</div><p>b &lt;c&gt; &#233;&#x41;</p></article>", "a\n\nb <c> éA"),
    ("<article><p>a</p></article><section id='comments'><p>first!</p></section>", "a"),
    ("<article><p>a</p><form><input><label>x</label></form><aside>s</aside><ul><li>one<li>two</ul></article>", "a\n\none\n\ntwo"),
    ("<main><h1>H</h1><p>1 < 2 and 3 > 2</p></main>", "H\n\n1 < 2 and 3 > 2"),
    ("<div class='sidebar'><p>many words in the sidebar</p></div><div class='post'><h1>H</h1><p>x</p></div>", "H\n\nx"),
    ("<div class='layout has-sidebar'><article><p>kept</p></article></div>", "kept"),
    ("<div class='content no-sidebar'><h1>H</h1><p>x</p></div>", "H\n\nx"),
    ("<div class='sidebar wide'><article><p>the only text here</p></article></div>", "the only text here"),
    ("<form action='/'><div class='body'><p>x y</p><p>z</p></div></form>", "x y\n\nz"),
    ("<article><section id='related-work'><h2 id='social-impact'>S</h2><p class='side-effects'>e</p></section></article>", "S\n\ne"),
    ("<article><p>a</p><div id='comments'><p>first!</p></div><div class='wp-block-search'>s</div></article>", "a"),
    ("<article><p>one</p><div class='related-posts'><p>r</p></div><span class='share-buttons'>s</span></article>", "one"),
    ("<aside><article><p>A teaser of another page</p></article></aside><div class='post'><p>The text of this page</p></div>", "The text of this page"),
    ("<article><p>main text of the page</p></article><div class='comments'><article><p>a reader</p></article></div>", "main text of the page"),
    ("<article><div class='[&>p]:mt-4'><p>x</p></div></article>", "x"),
    ("<div class='menu'>m</div>", None),
    ("<article><div class='entry-header'><h1>H</h1></div><p>x</p><p class='promo'>y</p></article>", "H\n\nx"),
]


@pytest.mark.parametrize("body,text", CASES)
def test_article_of_a_page(body, text):
    own = html_paths.Page(page(body))
    assert own.text([own.proposal()]) == text


def test_broken_pages():
    for source in ("", "<", "<p", "<p>a<", "</p></div>", "<script>x", "<!-- x", "<div " * 50, "&", "<article>"):
        own = html_paths.Page(source)
        own.text([own.proposal()])
    own = html_paths.Page("<html><body><article><p>a b</p><p>cut <b>in the mid")
    assert own.text([own.proposal()]) == "a b\n\ncut in the mid"


def test_deep_pages_take_time_by_their_length():
    """Fifty thousand nested containers, end tags that nothing opened, inline elements left open."""
    deep = "<div class='x'>" * 50_000 + "<p>text</p>" + "</b>" * 50_000
    began = time.monotonic()
    own = html_paths.Page(deep + "</div>" * 50_000 + "<b><p>" * 20_000)
    assert own.text([own.proposal()]) == "text"
    assert time.monotonic() - began < 20


def test_clashing_columns_of_pages(spark):
    rows = [(1, "http://a.b/", "<article>x</article>", "p", "q", "r", 5, 2)]
    df = spark.createDataFrame(rows, "page_id int, url string, html string, paths string, of_host string, own_host string, page_host int, text int")
    (got,) = html_paths.main_texts(df).collect()
    assert (got.paths, got.of_host, got.own_host, got.page_host, got.text, got.n_chars) == ("p", "q", "r", 5, "x", 1)


def test_host_paths_decide(spark):
    """A page whose article is short follows the path its host's other pages agree on."""
    rest = "<div class='x1'>Read this too: a long piece of text that no mark gives away, of many words.</div>"
    rows = [(i, "http://a.b/%d" % i, page(f"<div class='c{i}'><p>{'word ' * 60}</p></div>{rest}")) for i in range(9)]
    rows.append((9, "http://a.b/9", page(f"<div class='c9'><p>Short.</p></div>{rest}")))
    rows += [(10, None, None), (11, "no host", ""), (12, "http://a.b/", "<p>only this</p>"), rows[0]]
    df = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, text int")
    got = html_paths.main_texts(df.repartition(3)).collect()
    assert len(got) == len(rows)
    texts = {r.page_id: r.text for r in got}
    assert texts[9] == "Short." and texts[0] == ("word " * 60).strip()
    assert texts[10] == texts[11] == "" and texts[12] == "only this"
    assert all(r.n_chars == len(r.text) for r in got)
    alone = spark.createDataFrame([(1, "http://x.y/", page(rest + "<div class='q'><p>" + "long " * 50 + "</p></div>")), (2, "", "plain &amp; bare")], "page_id long, url string, html string")
    assert {r.page_id: r.text for r in html_paths.main_texts(alone).collect()} == {1: ("long " * 50).strip(), 2: "plain & bare"}
    assert html_paths.main_texts(df.limit(0)).collect() == []


def test_main_text_query(spark, small):
    """The pages' article element, by a plain reading of their simple markup."""
    from html import unescape

    pages = {r.page_id: r.html for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    got = QUERIES["op4_main_text"](spark, small).collect()
    assert len(got) == len(pages)
    for r in got:
        article = re.search(r"<article>(.*?)(</article>|$)", pages[r.page_id], re.S)[1]
        blocks = [re.sub(r"<[^>]*>", " ", x.replace("<b>", "")) for x in re.split(r"</?(?:p|h1)>", article)]
        blocks = [" ".join(unescape(x).split()) for x in blocks]
        assert r.text == "\n\n".join(x for x in blocks if x)


def brute_url(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return host.translate({i: i + 32 for i in range(65, 91)}), path


def brute_rule(host, path):
    fits = []
    for rule, verdict in RULES:
        own, rest = rule.split("/", 1)
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append((len(rule), rule, verdict))
    return max(fits)[1:] if fits else (None, None)


URLS = [
    None, "", "no scheme", "http://", "http://A.Example.COM/en/1", "https://www.example.com/en/", "http://example.com",
    "http://example.com?x=/en/", "http://example.com/en", "ftp://x.net/es/a#b", "http://net/fr/", "http://aexample.com/en/",
    "http://x.org/en/?page=1&ref=", "http://x.org/a://b/c", "http://É.com/en/", "http://h.com/\n/x", "http://www.example.com.net/es/q",
]


def test_hosts_paths_and_rules(spark):
    rows = [(i, u) for i, u in enumerate(URLS)] + [(0, None), (None, "http://x.net/es/")]
    df = spark.createDataFrame([(*r, "old") for r in rows], "page_id long, url string, verdict string")
    got = url_rules.judge(df, RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        host, path = brute_url(r.url)
        rule, verdict = brute_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule)
        assert r.verdict in ("allow", "block") and (verdict is None or r.verdict == verdict)
    assert url_rules.judge(df.limit(0), RULES).collect() == []
    assert df.select(host_of(df.url), path_of(df.url)).count() == len(rows)


def test_mined_rules(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        bad = i % 4 == 0
        kind = "?utm=1" if bad and i % 8 else ""
        rows.append((f"http://{'spam' if bad else 'good'}.host{rng.randrange(3)}.org/{rng.choice('ab')}/{i}{kind}", "block" if bad else "allow"))
    labelled = spark.createDataFrame(rows, "url string, label string")
    baskets = labelled.select(url_rules.tokens(labelled.url).alias("tokens"), "label")
    rules = url_rules.mine(baskets, 0.02, 0.9)
    seen = [(set(r.tokens), r.label) for r in baskets.collect()]
    assert rules
    for own, label, confidence, support in rules:
        fit = [y for x, y in seen if x >= set(own)]
        assert confidence == pytest.approx(fit.count(label) / len(fit)) and confidence >= 0.9
        assert support == pytest.approx(fit.count(label) / len(seen)) and support >= 0.02
        assert not any(set(o) < set(own) and y == label and c >= confidence for o, y, c, _ in rules)
    index = url_rules.inverted(rules)
    for x, _ in seen[:60]:
        fits = [r for r in rules if x >= set(r[0])]
        best = max(fits, key=lambda r: (r[2], r[3], len(r[0]), r[1], r[0]))[1] if fits else "allow"
        assert url_rules.decide(sorted(x), rules, index) == best
    new = spark.createDataFrame([(1, "http://a.org/q?utm=2"), (2, "http://b.org/zz")], "page_id long, url string")
    got = {r.page_id: r.verdict for r in url_rules.judge(new, [], labelled).collect()}
    assert got == {1: "block", 2: "allow"}


def test_rules_of_deep_segments_and_subdomains(spark):
    """What tells urls apart may stand anywhere; a long path that all of a site share is one token."""
    shared = "/".join("abcdefghijklmnopqrstuvwxy")
    rows = [(f"https://{'bad' if i % 3 == 0 else 'fine'}.blog.site.co.uk/{shared}/{i}", "block" if i % 3 == 0 else "allow") for i in range(90)]
    rows += [(f"http://x{i % 5}.org/a/b/{'casino' if i % 2 else 'garden'}/{i}", "block" if i % 2 else "allow") for i in range(90)]
    labelled = spark.createDataFrame([*rows, (None, "block"), ("http://x.org/", None)], "url string, label string")
    known = labelled.select(url_rules.tokens(labelled.url).alias("tokens"), "label")
    names = url_rules.same_urls(known)
    assert len({names[f"path{i}={c}"] for i, c in enumerate("cdefghijklmnopqrstuvwxy", 2)}) == 1
    new = spark.createDataFrame(
        [(1, "http://new.org/q/r/casino/z", "t", "g"), (2, "http://new.org/a/b/casino/z", "t", "g"),
         (3, "http://bad.blog.site.co.uk/", "t", "g"), (4, "http://fine.blog.site.co.uk/", "t", "g"), (5, None, "t", "g"),
         (6, "http://new.org/casino", "t", "g")],
        "page_id long, url string, tokens string, given string",
    )
    got = {r.page_id: r for r in url_rules.judge(new, [], labelled).collect()}
    assert {i: r.verdict for i, r in got.items()} == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}
    assert all(r.tokens == "t" and r.given == "g" for r in got.values())


def test_url_query(spark, small):
    got = QUERIES["op7_url_rules"](spark, small).collect()
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    assert list(URL_RULES) == RULES and len(got) == len(pages)
    for r in got:
        host, path = brute_url(pages[r.page_id])
        rule, verdict = brute_rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)
    known = spark.createDataFrame(
        [(u, brute_rule(*brute_url(u))[1]) for u in pages.values() if brute_rule(*brute_url(u))[1]], "url string, label string"
    )
    sets = {r.url: (set(r.tokens), r.label) for r in known.select("url", url_rules.tokens(known.url).alias("tokens"), "label").collect()}
    others = [(r.page_id, pages[r.page_id]) for r in got if r.rule is None][:40]
    own = spark.createDataFrame(others, "page_id long, url string")
    verdicts = {r.page_id: r.verdict for r in got}
    for r in own.select("page_id", url_rules.tokens(own.url).alias("tokens")).collect():
        assert verdicts[r.page_id] == brute_verdict(set(r.tokens), list(sets.values()))


def brute_verdict(own, known):
    """Of all token sets of the url that 1 % of the known urls have, the surest label with 80 % or more."""
    least, best = 0.01 * len(known), None
    frequent = [t for t in sorted(own) if sum(t in x for x, _ in known) >= least]
    for size in range(1, len(frequent) + 1):
        for need in itertools.combinations(frequent, size):
            fit = [label for x, label in known if x.issuperset(need)]
            for label in ("allow", "block"):
                n = fit.count(label)
                if n >= least and n >= 0.8 * len(fit):
                    rank = (n / len(fit), n)
                    if best is None or rank > best[0]:
                        best = (rank, {label})
                    elif rank == best[0]:
                        best[1].add(label)
    if best is None:
        return "allow"
    assert len(best[1]) == 1
    return best[1].pop()


def brute_nearest(vectors, every, k):
    ids = np.array(sorted(vectors))
    x = np.array([vectors[i] for i in ids], np.float64)
    out = {}
    for q in ids[ids % every == 0]:
        score = (x * vectors[q]).sum(1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:k]
        out[q] = [(int(ids[i]), float(score[i])) for i in order]
    return out


def test_full_search_is_exact(spark):
    """All leaves open: brute force, with odd rows, ties, one hot vector and norms that differ."""
    rng = np.random.default_rng(3)
    vectors = {i: (rng.normal(size=8) * rng.uniform(0.2, 3)).astype(np.float32).astype(float) for i in range(300)}
    for i in range(300, 500):
        vectors[i] = vectors[0]
    odd = [
        (900, None), (901, [0.0] * 8), (902, [1.0] * 7), (903, [float("nan")] + [1.0] * 7),
        (904, [float("inf")] + [1.0] * 7), (905, [None] + [1.0] * 7), (None, [1.0] * 8), (920, []),
    ]
    rows = [(i, [float(v) for v in x], 1) for i, x in vectors.items()] + [(i, x, 1) for i, x in odd]
    rows.append(rows[20])
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, rank int").repartition(3)
    got = {}
    for r in vector_forest.nearest(df, depth=3, trees=2, search_leaves=16, bin_rows=60).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    expected = brute_nearest(vectors, 20, 20)
    assert set(got) == set(expected)
    for q, rows_ in expected.items():
        assert [(r, v) for r, v, _ in got[q]] == [(i + 1, v) for i, (v, _) in enumerate(rows_)]
        assert np.allclose([s for *_, s in got[q]], [s for _, s in rows_], rtol=1e-12, atol=0)
    few = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0]), (20, [1.0, 1.0])], "vec_id long, embedding array<float>")
    assert {(r.query_id, r.rank, r.vec_id) for r in vector_forest.nearest(few).collect()} == {
        (0, 1, 1), (0, 2, 20), (20, 1, 0), (20, 2, 1),
    }
    assert vector_forest.nearest(df.limit(0)).collect() == []


@pytest.mark.parametrize("n", [5, 10, 50, 500, 700])
def test_small_tables_are_searched_whole(spark, n):
    """The default settings find all candidates, if fewer than k, and nearly all of the nearest."""
    rng = np.random.default_rng(n)
    vectors = {i: rng.normal(size=16) for i in range(n)}
    df = spark.createDataFrame([(i, x.tolist()) for i, x in vectors.items()], "vec_id long, embedding array<double>")
    got = {}
    for r in vector_forest.nearest(df).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    expected = brute_nearest(vectors, 20, 20)
    assert {q: len(x) for q, x in got.items()} == {q: len(x) for q, x in expected.items()}
    found = [len({v for v, _ in rows_} & got[q]) / len(rows_) for q, rows_ in expected.items()]
    assert np.mean(found) >= (1 if n <= 500 else 0.95)


def test_rows_beyond_the_sample_are_found(spark):
    rng = np.random.default_rng(8)
    vectors = {i: rng.normal(size=16) for i in range(1500)}
    df = spark.createDataFrame([(i, x.tolist()) for i, x in vectors.items()], "vec_id long, embedding array<double>")
    got = {}
    for r in vector_forest.nearest(df, sample=300).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    expected = brute_nearest(vectors, 20, 20)
    assert np.mean([len({v for v, _ in x} & got[q]) / 20 for q, x in expected.items()]) >= 0.9


def test_query_recall(spark):
    folder = "/root/testdata/sf0.1"
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    vectors = {r.vec_id: np.array(r.embedding, np.float64) for r in rows if r.embedding is not None}
    got = {}
    for r in QUERIES["op6_nearest_vectors"](spark, folder).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    expected = brute_nearest(vectors, 20, 20)
    assert set(got) == set(expected)
    recall = np.mean([len({v for v, _ in rows_} & got[q]) / len(rows_) for q, rows_ in expected.items()])
    assert recall >= 0.9
