"""Vector searches and page operators against brute force, and on awkward tables."""

import pickle

import numpy as np
import pytest
from pyspark import SparkContext
from pyspark.sql import functions as F

from tarnflow.llm import balltree, permutation, sitetree, urls
from tarnflow.llm.queries import URL_RULES


@pytest.fixture(scope="module")
def vectors(spark):
    r = np.random.default_rng(3)
    values = r.normal(size=(400, 8)).round(3)
    values[200:210] = values[7]  # ties
    rows = [(k, v.tolist()) for k, v in enumerate(values)] + [(20, values[20].tolist())]
    rows += [(500, None), (501, [0.0] * 8), (502, [float("nan")] * 8), (503, [1.0, None] * 4), (504, [float("inf")] * 8), (None, [1.0] * 8), (505, []), (506, [1.0, 2.0]), (510, [3.0, 1.0])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"id": F.lit(1), "v": F.lit(2), "size": F.lit(3)}), values


def ranked(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    return out


def test_exact_top_k(vectors):
    df, values = vectors
    got = ranked(balltree.top_k(df, F.col("id") % 10 == 0, k=5, factor=64, shard_rows=90, block_rows=13, seeds=20))
    whole = np.floor(values * 64)
    for q in range(0, 400, 10):
        score = whole @ whole[q]
        order = [int(k) for k in np.lexsort((np.arange(400), -score)) if k != q]
        # The zero vector takes part in a search by inner product.
        want = sorted([(-score[k], k) for k in order] + [(0.0, 501)])[:5]
        assert got[q] == [(k, -s) for s, k in want]
    assert got[510] == [(506, 64.0 * 3 * 64 + 64 * 2 * 64)]


def test_nearest(vectors):
    df, values = vectors
    found = permutation.nearest(df, F.col("id") % 10 == 0, k=5, shard_rows=100, block_rows=7)
    got = ranked(found)
    for q in range(0, 400, 10):
        far = np.sqrt(((values - values[q]) ** 2).sum(axis=1))
        order = [int(k) for k in np.lexsort((np.arange(400), far)) if k != q][:5]
        assert [k for k, _ in got[q]] == order and [s for _, s in got[q]] == pytest.approx(far[order].tolist(), abs=1e-12)
    assert 500 not in got and got[510] == [(506, pytest.approx(5**0.5))]
    assert permutation.nearest(df.limit(0), F.col("id") % 10 == 0).count() == 0
    assert balltree.top_k(df.limit(0), F.col("id") % 10 == 0).count() == 0


def test_recall_with_few_candidates(spark):
    r = np.random.default_rng(5)
    values = r.normal(size=(40, 16))[r.integers(0, 40, 3000)] + 0.3 * r.normal(size=(3000, 16))
    df = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(values)], "vec_id long, embedding array<double>")
    got = ranked(permutation.nearest(df, F.col("id") % 100 == 0, share=0.1, least=50))
    right = 0
    for q in range(0, 3000, 100):
        far = ((values - values[q]) ** 2).sum(axis=1)
        far[q] = np.inf
        right += len({k for k, _ in got[q]} & set(np.argsort(far)[:10].tolist()))
    assert right >= 0.9 * 300


@pytest.fixture
def sent(spark, monkeypatch):
    """Bytes of each broadcast from Python; Spark's own broadcasts of tables may have 50 kB."""
    sizes, plain, limit = [], SparkContext.broadcast, "spark.sql.maxBroadcastTableSize"
    monkeypatch.setattr(SparkContext, "broadcast", lambda self, value: sizes.append(len(pickle.dumps(value))) or plain(self, value))
    before = spark.conf.get(limit)
    spark.conf.set(limit, "50k")
    yield sizes
    spark.conf.set(limit, before)


def test_nearest_sends_queries_once(vectors, sent):
    df, values = vectors
    # All 400 vectors ask, 29 kB; a copy for each of 40 shards is over a MB.
    got = ranked(permutation.nearest(df, F.col("id") < 400, k=5, shard_rows=10, block_rows=30, round_bytes=9000))
    for q in range(400):
        far = np.sqrt(((values - values[q]) ** 2).sum(axis=1))
        assert [k for k, _ in got[q]] == [int(k) for k in np.lexsort((np.arange(400), far)) if k != q][:5]
    # Three rounds or more, each with its queries and the pivots.
    assert len(sent) >= 3 and max(sent) < 9000 + 256 * 8 * 8 + 4000


def test_top_k_sends_queries_once(vectors, sent):
    df, values = vectors
    got = ranked(balltree.top_k(df, F.col("id") < 400, k=5, factor=64, shard_rows=10, block_rows=30, seeds=20, round_bytes=9000))
    whole = np.floor(values * 64)
    for q in range(400):
        score = whole @ whole[q]
        want = sorted([(-score[k], k) for k in range(400) if k != q] + [(0.0, 501)])[:5]
        assert got[q] == [(k, -s) for s, k in want]
    assert len(sent) >= 3 and max(sent) < 9000 + 20 * 9 * 8 + 4000


def test_footrule():
    order = np.array([[0, 1, 2], [2, 1, 0], [3, 4, 0]])
    files = permutation.InvertedFiles(order, 5)

    def slow(a, b):
        place = lambda x, p: list(x).index(p) if p in x else 3
        return sum(abs(place(a, p) - place(b, p)) for p in {*a, *b})

    assert files.footrule(np.array([0, 1, 2])).tolist() == [slow(o, [0, 1, 2]) for o in order]


PAGES = [
    (1, "http://www.A.example.com/en/x?q#f", None), (2, "https://shop.net/es/1", ""), (3, "https://alias.org/p", '<link rel="canonical" href="https://shop.net/es/1">'),
    (4, "https://b.org/q", '<meta http-equiv="refresh" content="0; url=https://alias.org/p">'), (5, "https://c.org/", '<LINK href="https://good.com/" rel=canonical>'),
    (6, None, "x"), (7, "no scheme", None), (8, "", None), (9, "http://alias.org/p/?utm_source=z", None),
    (10, "https://d.org/r", '<link rel="canonical" href="https://c.org/"><meta property="og:url" content="https://shop.net/es/1">'),
    (2, "https://shop.net/es/1", ""), (None, "https://example.com", None),
]


def test_url_rules(spark):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumns({"host": F.lit("h"), "a": F.lit("a"), "node": F.lit("n")})
    got = {r["page_id"]: r for r in urls.judged(pages, URL_RULES, og_url=True, spellings=True).collect()}
    assert (got[1]["host"], got[1]["path"], got[1]["rule"], got[1]["verdict"]) == ("www.a.example.com", "/en/x", "example.com/en/", "block")
    assert (got[2]["rule"], got[2]["verdict"]) == ("net/es/", "block")
    # Pages 5 and 10 tie the blocked component to an explicitly allowed host.
    assert {got[k]["verdict"] for k in (3, 4, 5, 9, 10)} == {"allow"} and got[3]["rule"] is None
    assert [(got[k]["host"], got[k]["path"], got[k]["verdict"]) for k in (6, 7, 8)] == [("", "", "allow")] * 3
    assert (got[None]["host"], got[None]["path"], got[None]["rule"]) == ("example.com", "", None)
    without = pages.where("page_id is null or page_id not in (5, 10)")
    got = {r["page_id"]: r for r in urls.judged(without, URL_RULES, og_url=True, spellings=True).collect()}
    assert {got[k]["verdict"] for k in (3, 4, 9)} == {"block"} and all(got[k]["rule"] is None for k in (3, 4, 9))
    assert urls.judged(pages, URL_RULES, og_url=True, spellings=True).count() == len(PAGES) and urls.judged(pages.limit(0), URL_RULES).count() == 0
    more = spark.createDataFrame([("https://e.org/", "https://shop.net/es/1"), (None, "x")], "a string, b string")
    one = pages.where("page_id in (2, 5)").withColumn("url", F.when(F.col("page_id") == 5, "https://e.org/").otherwise(F.col("url"))).withColumn("html", F.lit(None).cast("string"))
    assert {r["page_id"]: r["verdict"] for r in urls.judged(one, URL_RULES, more).collect()} == {2: "block", 5: "block"}


def test_url_components_by_brute_force(spark):
    r = np.random.default_rng(5)
    sites = ["http://a.org", "https://www.b.org", "https://shop.net/es", "https://x.net/fr", "https://good.com", "https://example.com/en"]
    names = [f"{s}/{k}" for s in sites[:2] for k in range(60)] + [f"{s}/{k}" for s in sites[2:] for k in range(6)]
    rows, same = [], {n: n for n in names}

    def top(n):
        while same[n] != n:
            n = same[n]
        return n

    for k in range(200):
        here, there = r.choice(names[:120]), r.choice(names)
        link = f'<link rel="canonical" href="{there}">' if k % 2 else f'<meta http-equiv="refresh" content="0;url={there}">'
        rows.append((k, here, link if k % 3 else "<p>none</p>"))
        if k % 3:
            same[top(here)] = top(there)
    rows += [(300, "http://a.org/0?ref=x", ""), (301, "http://www.a.org/0", '<meta property="og:url" content="https://shop.net/es/1">')]
    fates = {}
    for n in names:
        own = "block" if ".net/" in n or "example.com" in n else "allow" if "good.com" in n else None
        fates.setdefault(top(n), set()).add(own)
    got = {p["page_id"]: (p["rule"], p["verdict"]) for p in urls.judged(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()}
    for k, url, _ in rows[:200]:
        fate = fates[top(url)]
        assert got[k] == (None, "block" if "block" in fate and "allow" not in fate else "allow"), url
    assert got[300] == got[301] == (None, "allow") and {v for _, v in got.values()} == {"allow", "block"}


HTML = """<html><head><title>T</title></head><body class="home"><header><h1>Site</h1></header><nav>menu</nav><div class="cookie-notice">We use</div>
<main><article><header><h1>Head &amp; line</h1></header><p>One<b>two</b> <i>three</i><p>Four &lt;x&gt; &nbsp; 5 < 6<ul><li>a<li>b</ul><table><tr><td>c<td>d<tr><td>e</table>
<script>if(a<b){"</p>"}</script><aside>side</aside><form><input>go</form>tail<footer>foot</footer></article><section id="comments"><p>nice</p></section></main><footer>f</footer>"""


def test_reading_a_page():
    assert sitetree.read(HTML) == "Head & line Onetwo three Four <x> 5 < 6 a b c d e tail"
    assert sitetree.read("<div><p>plain page</p><div class=sidebar>x</div></div><p>more") == "plain page more"
    assert [sitetree.read(t) for t in ("", "<nav>a</nav>", "a < b <", "<!-- x", "<p title='a>b'>t</p>")] == ["", "", "a < b <", "", "t"]


def test_site_trees(spark):
    rows = [(k, f"https://h.org/{k}", f"<div class=box><p>Same words everywhere</p></div><div class=body><p>Story {k} {'abcdefgh'[k]}</p></div>") for k in range(8)]
    rows += [(20 + k, f"https://copy.org/{k}", f"<nav>n{k}</nav><article><p>One text under one host</p></article>") for k in range(8)]
    rows += [(40, None, None), (41, "x", ""), (None, "https://h.org/z", "<p>z"), (1, rows[1][1], rows[1][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("t"), "host": F.lit("h"), "path": F.lit(0)})
    found = sitetree.extract(pages).collect()
    got = {r["page_id"]: r["text"] for r in found}
    assert len(found) == len(rows) and all(got[k] == f"Story {k} {'abcdefgh'[k]}" for k in range(8))
    assert all(got[20 + k] == "One text under one host" for k in range(8)) and got[40] == got[41] == "" and got[None] == "z"
    assert all(r["n_chars"] == len(r["text"]) for r in found) and sitetree.extract(pages.limit(0)).count() == 0


def test_repeated_notices_inside_articles(spark):
    """Notices without a telling class go, by node or by content, as a merge of the trees in one place finds them."""
    import math
    from collections import Counter, defaultdict

    notice, plea = "<div class=x9><p>This site is kept by friends.</p></div>", "<p>Please write to us.</p>"
    rows = []
    for k in range(12):
        body = f"<article><h1>Head {k}</h1>{notice if k % 6 else ''}<p>Story {k} one</p>{plea if k != 3 else ''}<p>Story {k} two</p></article>"
        rows.append((k, f"https://n.org/{k}", body))
    rows += [(30 + k, f"https://other.org/{k}", f"<article><p>Own {k}</p>{plea if k == 0 else ''}</article>") for k in range(6)]
    rows += [(50 + k, f"https://n.org/c{k}", f"<nav>{k}</nav><article><p>Copied one</p><p>Copied two</p></article>") for k in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r["page_id"]: r["text"] for r in sitetree.extract(pages).collect()}
    assert all(got[k] == f"Head {k} Story {k} one Story {k} two" for k in range(12))
    assert got[30] == "Own 0 Please write to us." and all(got[50 + k] == "Copied one Copied two" for k in range(20))

    mains, seen, contents = defaultdict(set), defaultdict(lambda: (set(), set())), defaultdict(set)
    for _, url, html in rows:
        name, nodes = url.split("/")[2], []
        main = sitetree.read(html, nodes=nodes)
        mains[name].add(main)
        for path, looks, says in nodes:
            seen[name, path][0].add((main, looks))
            seen[name, path][1].add((main, says))
            if says:
                contents[name, path, says].add(main)

    def entropy(pairs):
        n = Counter(v for _, v in pairs)
        return -sum(c / len(pairs) * math.log(c / len(pairs)) for c in n.values()) / math.log(len(pairs))

    want = {(*node, None) for node, kinds in seen.items() if min(map(len, kinds)) >= 4 and max(map(entropy, kinds)) < 0.2}
    want |= {c for c, on in contents.items() if len(on) >= 4 and 1 - math.log(len(on)) / math.log(len(mains[c[0]])) < 0.2}
    found = sitetree.unimportant(sitetree.nodes_of(pages, "url", "html").distinct()).collect()
    assert {(r["host"], r["path"] % 2**64, r["says"]) for r in found} == want and len(want) == len(found) > 2


@pytest.mark.parametrize("tag, want", [
    ('<link rel="canonical" href="/es/x">', "https://h.net/es/x"), ("<link rel=canonical href=x.html>", "https://h.net/a/x.html"),
    ('<link rel="canonical" href="//shop.net/es/1">', "https://shop.net/es/1"), ('<meta property="og:url" content="../es/./y">', "https://h.net/es/y"),
    ('<meta http-equiv="refresh" content="0; url=/es/z">', "https://h.net/es/z"), ("<meta http-equiv=refresh content=\"0;URL='q?b=1&amp;c=2'\">", "https://h.net/a/q?b=1&c=2"),
    ('<link rel="canonical" href="https:&#x2F;&#47;s.net/?a=1&amp;amp;b">', "https://s.net/?a=1&amp;b"), ('<link rel="canonical" href="?p=2">', "https://h.net/a/b?p=2"),
    ('<meta property="og:url" content=" https://s.net/es/ ">', "https://s.net/es/"), ('<link rel="canonical" href="javascript:x">', None),
])
def test_targets_of_every_form(spark, tag, want):
    pages = spark.createDataFrame([("https://h.net/a/b?k=v#f", tag), (None, tag), ("no scheme", tag if want is None else "")], "url string, html string")
    assert [r["b"] for r in urls.links(pages, og_url=True).collect()] == ([want] if want else [])
