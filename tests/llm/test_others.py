"""Pages, vectors and conversations against plain Python, with odd rows."""

import numpy as np
import pytest
from llm_fixtures import ws  # noqa: F401
from pyspark.sql import functions as F

from barlab.llm import projection_forest, site_templates, snapshots, url_lm

PAGES = "page_id long, url string, html string"


def test_host_path_and_rules(spark, ws):
    urls = {1: ("http://WWW.Example.com/en/x?q#f", "www.example.com", "/en/x", "www.example.com/en/", "allow"),
            2: ("https://a.example.com/en/", "a.example.com", "/en/", "example.com/en/", "block"),
            3: ("https://a.example.com/fr/", "a.example.com", "/fr/", "com/", "allow"),
            4: ("x://net/es/1", "net", "/es/1", "net/es/", "block"), 5: ("x://b.net/fr/1#://com/", "b.net", "/fr/1", "net/fr/", "block"),
            6: (None, "", "", None, None), 7: ("no scheme", "", "", None, None), 8: ("http://a.com", "a.com", "", None, None),
            9: ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"), 10: ("http://xnet/es/", "xnet", "/es/", None, None),
            11: ("", "", "", None, None), 12: ("http://a.org?b=http://c.com/", "a.org", "", None, None)}
    df = spark.createDataFrame([(i, u[0], 1) for i, u in urls.items()], "page_id long, url string, rule int")
    got = {r.page_id: r for r in url_lm.judge_urls(ws, df).collect()}
    assert len(got) == len(urls)
    for i, (_, host, path, rule, verdict) in urls.items():
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert url_lm.judge_urls(ws, df.limit(0)).count() == 0


def brute_scores(train, urls):
    """Witten-Bell over contexts of 0 to ORDER symbols."""
    import re

    def fold(u):
        u = "".join(c.lower() if "A" <= c <= "Z" else c for c in u or "")
        u = re.sub(r"[^a-z0/.\-_?=&#%:]", "*", re.sub("[0-9]", "0", u))
        return "^" * url_lm.ORDER + u + "$"

    counts = {"allow": {}, "block": {}}
    for label, u in train:
        s = fold(u)
        for i in range(url_lm.ORDER, len(s)):
            for k in range(url_lm.ORDER + 1):
                c = counts[label].setdefault(s[i - k:i], {})
                c[s[i]] = c.get(s[i], 0) + 1

    def p(label, ctx, x):
        q = 1 / len(url_lm.ALPHABET)
        for k in range(url_lm.ORDER + 1):
            c = counts[label].get(ctx[len(ctx) - k:])
            if c:
                q = (c.get(x, 0) + len(c) * q) / (sum(c.values()) + len(c))
        return q

    out = {}
    for u in urls:
        s = fold(u)
        logs = [np.log(p("allow", s[i - 3:i], s[i])) - np.log(p("block", s[i - 3:i], s[i])) for i in range(3, len(s))]
        out[u] = sum(logs) / len(logs)
    return out


def test_url_scores(spark, ws):
    urls = [f"https://good{i}.com/news/item{i}" for i in range(30)] + [f"http://bad{i}.net/es/win-{i}" for i in range(30)]
    urls += ["https://good.org/news/9", "http://bad.org/es/win-7", "É://x"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    held = {r.url: r.h for r in df.select("url", (F.pmod(F.xxhash64("url"), F.lit(url_lm.HELD_OUT_FOLDS)) == 0).alias("h")).collect()}
    train = [("allow" if ".com/" in u else "block", u) for u in urls[:60] if not held[u]]
    got = {r.page_id: r for r in url_lm.judge_urls(ws, df).collect()}
    for i, u in enumerate(urls):
        assert got[i].score == pytest.approx(brute_scores(train, [u])[u], abs=1e-9)
    assert (got[60].verdict, got[61].verdict) == ("allow", "block")


def test_no_model_without_both_classes(spark, ws):
    df = spark.createDataFrame([(1, "http://a.com/x"), (2, "http://a.org/x"), (2, "http://a.org/x")], "page_id long, url string")
    assert sorted((r.page_id, r.verdict, r.score) for r in url_lm.judge_urls(ws, df).collect()) == [
        (1, "allow", None), (2, "allow", None), (2, "allow", None)]


def page(body, head="<title>T</title>"):
    return f"<!DOCTYPE html><html><head>{head}</head><body>{body}</body></html>"


def test_extraction(spark, ws):
    cases = {
        "<nav><p>menu</p></nav><article><h1>A &amp; B</h1><p>one\n two</p><p>three<br>four <b>x</b>y</p></article><footer>f</footer>":
            "A & B\none two\nthree\nfour xy",
        "<main><p>a<p>b<script>var t='</main><p>no';</script><style>p{}</style><!-- <p>no</p> --><ul><li>1<li>2</ul></main><p>out": "a\nb\n1\n2",
        "<div id=cookie-notice>no</div><p>text</p><aside>no</aside><form><p>no</form><div class='post comments'>no</div>": "text",
        "<article><p>a</p><div class=\"ad\">no</div><p>b &lt;i&gt; &#233;</article>": "a\nb <i> é",
        "<p>cut off <b>here": "cut off here", "<article></article>": "", "5 < 6 <3": "5 < 6 <3",
        "<article><p>one</article><div>x</div><article><p>two</article>": "one\ntwo", "<p title=\"a>b\">q</p><p title='unclosed>r</p>": "q\nr",
    }
    rows = [(i, f"http://h{i}.org/", page(b)) for i, b in enumerate(cases)]
    rows += [(100, None, None), (101, "x", ""), (102, "http://h.org/", "plain text")]
    got = {r.page_id: r for r in site_templates.extract(ws, spark.createDataFrame(rows, PAGES).withColumn("host", F.lit(1))).collect()}
    want = dict(enumerate(cases.values())) | {100: "", 101: "", 102: "plain text"}
    assert {i: r.text for i, r in got.items()} == want
    assert all(r.n_chars == len(r.text) for r in got.values())
    assert site_templates.extract(ws, spark.createDataFrame([], PAGES)).count() == 0


def test_templates_are_recurring_subtrees(spark, ws):
    rows = [(i, f"https://site.org/{i}", page(f"<div><p>Welcome to the site</p><span>v1</span></div><div><p>story {i}</p><p>tail</p></div>"))
            for i in range(10)]
    rows += [(50, "https://other.org/", page("<div><p>Welcome to the site</p><span>v1</span></div>"))]
    rows += [(60 + i, "https://art.org/", page(f"<article><p>A common line.</p><p>{i}</p></article>")) for i in range(10)]
    got = {r.page_id: r.text for r in site_templates.extract(ws, spark.createDataFrame(rows, PAGES)).collect()}
    assert got[3] == "story 3"  # the block and the closing line recur on the site
    assert got[50] == "Welcome to the site\nv1"
    assert got[64] == "A common line.\n4"  # text of an article isn't template


def test_labels_are_whole_names(spark, ws):
    kept = ['p title="the hidden cost of things"', 'p data-id="comment-5"', "div data-class=ad", "div title='a class=ad b'", 'h2 id="search-engines"',
            'h2 id="Social_policy"', 'h2 id="search"', 'p class="notice"', 'section class="related-work"', 'div class="article-header"', 'div class="has-sidebar"',
            'div data-hidden', 'div aria-hidden="false"', 'div data-x="1"id="y" class="post"', 'div id="a" id="ad"', "div title='class=\"ad\"'", 'div class="ad-é"']
    dropped = ['div class="ad"', "div class='post comments'", "div id=cookie-notice", 'section id="comment-5"', 'div CLASS = "x Ad-Box"', "p hidden", 'p hidden=""',
               'p aria-hidden="true"', 'div title="x"class="sidebar_left"', "div role=navigation", 'p role="alert"', "ul class=share"]
    tags = [(t, True) for t in kept] + [(t, False) for t in dropped]
    for main in ("article", "div"):
        rows = [(i, f"http://{main}{i}.org/", page(f"<{main}><p>a</p><{t}>text</{t.split()[0]}><p>b</p></{main}>")) for i, (t, _) in enumerate(tags)]
        got = {r.page_id: r.text for r in site_templates.extract(ws, spark.createDataFrame(rows, PAGES)).collect()}
        for i, (t, keep) in enumerate(tags):
            assert got[i] == ("a\ntext\nb" if keep else "a\nb"), t


def test_copies_of_a_page_are_one_witness(spark, ws):
    def article(i):
        return f"<div><article><h1>T{i}</h1><div><p>story {i}</p><ul><li>item {i}</li></ul></div></article></div>"

    rows = [(i, f"https://copy.org/a?utm={i}", page(article(0), f"<link href='?utm={i}'>")) for i in range(12)]  # tracking parameters
    rows += [(20 + i, f"https://copy.org/print/{i}", page("<nav>menu</nav>" + article(0))) for i in range(4)]
    rows += [(30 + i, f"https://copy.org/{i}", page(article(i + 1))) for i in range(3)]
    rows += [(40 + i, f"https://plain.org/{i}", page("<div><p>one page</p><p>many URLs</p></div>")) for i in range(9)]
    # a block of all distinct pages is template, however many copies stand beside them
    rows += [(50 + i, f"https://mixed.org/{i}", page(f"<div><p>Welcome</p></div><p>text {max(0, i - 40)}</p>")) for i in range(45)]
    got = {r.page_id: r.text for r in site_templates.extract(ws, spark.createDataFrame(rows, PAGES)).collect()}
    assert {got[i] for i in [*range(12), *range(20, 24)]} == {"T0\nstory 0\nitem 0"}
    assert got[31] == "T2\nstory 2\nitem 2"
    assert {got[40 + i] for i in range(9)} == {"one page\nmany URLs"}
    assert got[50] == "text 0" and got[94] == "text 4"


def test_deep_and_long_pages(spark, ws):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, "http://a.org/", page(deep)), (2, "http://a.org/", page("<p>" + "word " * 100_000)), (3, "http://a.org/", "<" * 5000)]
    got = {r.page_id: r.n_chars for r in site_templates.extract(ws, spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {1: 1, 2: 499_999, 3: 5000}


VECTORS = "vec_id long, embedding array<float>, label int"


def nearest(rows, every=50, k=5):
    ids, seen = [], {}
    for i, v in rows:
        if i is None or v is None or not v or any(x is None or not np.isfinite(x) for x in v) or not any(v) or len(v) != 16:
            continue
        seen.setdefault(i, np.array(v, np.float32).astype(float))
    out = []
    for q in sorted(i for i in seen if i % every == 0):
        sc = [(-float(seen[q] @ v / (np.sqrt(seen[q] @ seen[q]) * np.sqrt(v @ v))), i) for i, v in seen.items() if i != q]
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(sorted(sc, key=lambda t: (round(t[0], 12), t[1]))[:k])]
    return out


def test_neighbours(spark, ws):
    g = np.random.default_rng(4)
    centres = g.standard_normal((12, 16))
    rows = [(i, [float(np.float32(x)) for x in centres[i % 12] + 0.3 * g.standard_normal(16)]) for i in range(600)]
    rows += [(1000 + i, rows[0][1]) for i in range(200)]  # one vector, many times
    rows += [(2000, None), (2001, [0.0] * 16), (2002, [float("nan")] * 16), (2050, [None] + [1.0] * 15), (2100, []), (2150, [1.0]), (None, [1.0] * 16), rows[5]]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], VECTORS).withColumn("rep", F.lit(1))
    got = sorted(tuple(r) for r in projection_forest.neighbours(ws, df).collect())
    want = nearest(rows)
    assert [x[:2] for x in got] == [x[:2] for x in want]
    hits = len({(x[0], x[2]) for x in got} & {(x[0], x[2]) for x in want})
    assert hits >= 0.9 * len(want)
    true = {(x[0], x[2]): x[3] for x in want}
    assert all(abs(x[3] - true[x[0], x[2]]) < 1e-12 for x in got if (x[0], x[2]) in true)
    assert [x[2] for x in got if x[0] == 0] == [1000, 1001, 1002, 1003, 1004]


def test_few_and_no_vectors(spark, ws):
    df = spark.createDataFrame([(0, [1.0, 0.0], 0), (7, [1.0, 1.0], 0), (50, [0.0, 1.0], 0)], VECTORS)
    got = sorted(tuple(r)[:3] for r in projection_forest.neighbours(ws, df).collect())
    assert got == [(0, 1, 7), (0, 2, 50), (50, 1, 7), (50, 2, 0)]
    assert projection_forest.neighbours(ws, df.limit(0)).count() == 0
    assert projection_forest.neighbours(ws, df.limit(1)).count() == 0


def test_forest_recall_on_given_vectors(spark, ws):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    x = np.array([v for _, v in rows], float)
    u = x / np.sqrt((x * x).sum(axis=1, keepdims=True))
    ids = np.array([i for i, _ in rows])
    got = {(r.query_id, r.vec_id) for r in projection_forest.neighbours(ws, df).collect()}
    want = set()
    for q in np.flatnonzero(ids % 50 == 0):
        s = u @ u[q]
        s[q] = -9
        want |= {(ids[q], ids[n]) for n in np.argsort(-s)[:5]}
    assert len(got & want) >= 0.9 * len(want)


def maximal(rows):
    """Conversations as tuples of distinct sorted turns; those that no longer one starts with, once each."""
    conv = {}
    for c, t, r, x in rows:
        if c is not None:
            conv.setdefault(c, set()).add((t, r, x))
    key = lambda y: tuple((v is not None, v if v is not None else "") for v in y)
    seqs = {c: [(r, x) for _, r, x in sorted(ts, key=key)] for c, ts in conv.items()}
    whole = {}
    for c in sorted(seqs):
        whole.setdefault(tuple(seqs[c]), []).append(c)
    strict = {s[:n] for s in whole for n in range(1, len(s))}
    out = []
    for s, cs in whole.items():
        if s not in strict:
            chat = "".join(f"<|im_start|>{r or ''}\n{x or ''}<|im_end|>\n" for r, x in s)
            out.append((cs[0], len(s), len(cs), chat))
    return sorted(out)


def test_snapshots(spark, ws):
    rows = []
    for c, texts in {1: "a", 2: "ab", 3: "abc", 4: "abd", 5: "abc", 6: "x", 9: "abcdefgh", 10: "b"}.items():
        rows += [(c, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]
    rows += [(7, 0, None, None), (8, 0, "", ""), (11, None, "user", "a"), (None, 0, "user", "a"), (12, 5, "user", "a"), (12, 5, "user", "a"),
             (12, 5, "assistant", "z"), (13, 4000, "assistant", "b"), (13, 3, "user", "a")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("pos", F.lit(1))
    assert sorted(tuple(r) for r in snapshots.collapse_and_format(ws, df).collect()) == maximal(rows)
    assert snapshots.collapse_and_format(ws, df.limit(0)).count() == 0
