from __future__ import annotations

import time

import numpy as np
from pyspark.sql import functions as F

from llm import html, neighbours, urls

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>x";</script></head>
<body><div class="cookie-notice">We use cookies.</div><header><a href=/>Home</a></header>
<nav><ul><li><a>One</a><li><a>Two</a></ul></nav><div id="sidebar"><p>Side text that is rather long, long enough.</p></div>
<article><h1>Head &amp; line</h1><p>First <b>bold</b> text&nbsp;with
 several   words in it, so that it is long.<p>Second paragraph is long enough to be content, too.
<p>Short.</p><div class="ad">Buy now</div><form><input><button>Send</button></form>
<p>Third paragraph, again of some length, ends it.</p></article>
<section class="comments"><p>A reader says that this comment is long enough to look like text.</p></section>
<footer>&copy; nobody</footer></body></html>"""


def test_main_text():
    assert html.main_text(PAGE) == (
        "Head & line\nFirst bold text with several words in it, so that it is long.\n"
        "Second paragraph is long enough to be content, too.\nShort.\n"
        "Third paragraph, again of some length, ends it."
    )
    assert html.main_text("") == ""
    assert html.main_text("just text") == "just text"
    assert html.main_text("<p>a<p>b &lt;c&gt;<br>d</p") .startswith("a\nb <c> d")
    assert html.main_text("<nav>menu</nav>") == ""


LONG = "A sentence that is long enough to be a part of the text of an article. "


def test_article_text_in_several_elements():
    p = lambda n: f"<p>{LONG * n}</p>"
    text = lambda *sizes: "\n".join((LONG * n).strip() for n in sizes)
    page = lambda body: html.main_text(f"<html><body><nav>menu</nav>{body}<footer>end</footer></body></html>")
    title = "<h1>Title</h1>"
    assert page(f"<article>{title}<p>Lead</p><div class=body>{p(9)}</div></article>") == "Title\nLead\n" + text(9)
    assert page(f"<article><section>{p(6)}</section><section>{p(4)}</section></article>") == text(6, 4)
    assert page(f"<div><div>{p(6)}</div><div class=ad>Buy</div><div>{p(3)}</div><div>{p(1)}</div></div>") == text(6, 3, 1)
    assert page(f"<div>{title}</div><div>{p(6)}</div>") == "Title\n" + text(6)
    assert page(f"<main>{title}<article>{p(6)}</article></main>") == "Title\n" + text(6)
    assert html.main_text(f"{title}<div>{p(6)}</div>") == "Title\n" + text(6)
    # Another article beside it is not its text.
    assert page(f"<article>{title}<div>{p(6)}</div></article><article>{p(1)}</article>") == "Title\n" + text(6)


def test_names_of_wrappers_do_not_mark_the_article():
    text = (LONG * 6).strip()
    p = f"<p>{text}</p>"
    page = lambda body: html.main_text(f"<html><body>{body}<footer>end</footer></body></html>")
    for name in ("site has-sidebar", "no-sidebar", "page--with-header", "nav-open", "layout-sidebar-left", "widget"):
        assert page(f"<div class='{name}'><article>{p}</article></div>") == text
        assert page(f"<div id='{name}'><main>{p}<div class='share-buttons'>Share</div></main></div>") == text
        assert page(f"<div class='{name}'><div>{p}</div><div class=ad>Buy</div></div>") == text
    assert page(f"<article><h1>T</h1><div class=widget>{p}</div></article>") == "T\n" + text
    table = "<table class='share-prices'><tr><td>Price</td></tr></table>"
    assert page(f"<article>{p}{table}{p}</article>") == f"{text}\nPrice\n{text}"
    assert page(f"<div class=promo>{p}</div><div class=banner>{p}</div>") == f"{text}\n{text}"
    # What is beside the article stays out, however long it is.
    for other in ("comments", "related", "sidebar"):
        assert page(f"<article>{p}</article><div class={other}><article>{p * 3}</article></div>") == text
    assert page(f"<div>{p}</div><div id=comments><article>{p * 3}</article></div>") == text


def p(*sizes):
    return "".join(f"<p>{LONG * n}</p>" for n in sizes)


def text(*sizes):
    return "\n".join((LONG * n).strip() for n in sizes)


def test_what_is_around_the_article_does_not_hide_it():
    form = "<html><body><form action=x><input name=v><nav>menu</nav>{}</form></body></html>"
    assert html.main_text(form.format(f"<div>{p(5, 4)}</div>")) == text(5, 4)
    assert html.main_text(form.format(f"<article><h1>T</h1>{p(5)}</article>")) == "T\n" + text(5)
    inside = "<form><p>Write to us</p><input></form>"
    assert html.main_text(f"<article>{p(5)}{inside}{p(4)}</article>") == text(5, 4)


def test_marked_paragraphs_go():
    marked = "<p class='advert'>Buy this.</p><p id='cookie-notice'>We use cookies on this page.</p>"
    assert html.main_text(f"<article>{p(5)}{marked}{p(3)}</article>") == text(5, 3)
    vague = "<p class='search-result-header'>About.</p>"
    assert html.main_text(f"<article>{p(5)}{vague}</article>") == text(5) + "\nAbout."


def test_vague_names_do_not_hide_what_reads_like_the_article():
    body = f"<h1>T</h1>{p(4)}<div class='search'>{p(3)}</div><div class='menu'>{p(2)}</div>{p(2)}"
    links = "<div class=menu><a href=x>One</a><a>Two</a></div><div class=search>Find</div>"
    assert html.main_text(f"<article>{body}{links}</article>") == "T\n" + text(4, 3, 2, 2)
    title = "<div class='header'><h1>Title</h1></div>"
    assert html.main_text(f"<article>{title}{p(5)}</article>") == "Title\n" + text(5)


def test_lists_of_comments_go():
    for name in ("commentlist", "comment-area", "comments", "comment_form"):
        page = f"<body><div>{p(2)}</div><ol class='{name}'><li>{LONG * 9}</li></ol></body>"
        assert html.main_text(page) == text(2)


def test_clusters_tell_text_from_menus_without_names():
    """No semantic elements and no names: only the ratio of text to tags tells what is what."""
    menu = "<ul>" + "".join(f"<li><a href=/{k}>Item {k}</a></li>" for k in range(9)) + "</ul>"
    body = f"<div><h1>T</h1>{p(5, 1)}<p>Short.</p>{p(4, 6, 3)}</div>"
    end = "<div><a>Imprint</a> <a>Contact</a></div>"
    page = f"<body><div>{menu}</div>{body}{end}</body>"
    want = "\n".join(["T", text(5, 1), "Short.", text(4, 6, 3)])
    assert html.main_text(page) == want
    loose = html.main_text(page, clusters=False)
    assert "Item 3" in loose and "Imprint" in loose and loose != want


def test_deep_and_broken_pages_take_linear_time():
    n = 30_000
    pages = [
        "<div>x" * n, "<div>" * n + "</section>" * n, "<li><ul>" + "<div>" * n + "<li></li>" * n,
        "<div class=ad>x" * n, "<b>" * n + "</i>" * n, "<div class='x menu'><article>x" * n, "<p>" * n,
    ]
    for page in pages:
        begin = time.perf_counter()
        html.main_text(page)
        assert time.perf_counter() - begin < 20
    assert html.main_text("<div>x" * 50) == "\n".join("x" * 50)


def test_extract(spark):
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None), (2, "v", "", "y"), (3, "w", "<p>" + "long " * 200_000, "z")]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string")).collect()
    assert sorted((str(r.page_id), r.n_chars) for r in found) == sorted(
        [("1", len(html.main_text(PAGE))), ("1", len(html.main_text(PAGE))), ("None", 0), ("2", 0), ("3", 999_999)]
    )
    assert all(r.n_chars == len(r.text) for r in found)
    assert html.extract(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def differ(hits, n, all_hits, all_n):
    rest_hits, rest = all_hits - hits, all_n - n
    if not n or not rest:
        return False
    p = all_hits / all_n
    return abs(hits / n - rest_hits / rest) > 1.96 * (p * (1 - p) * (1 / n + 1 / rest)) ** 0.5


def grow_tree(paths, state):
    """Templates level by level, without any step that is passed over."""
    while any(parts for _, parts in state.values()):
        branch, node, after = {}, {}, {}
        for key, (template, parts) in state.items():
            if parts:
                b = branch.setdefault((key[0], template, parts[0]), [0, 0, 0])
                for k in range(3):
                    b[k] += paths[key][k]
        for (host, template, _), b in branch.items():
            n = node.setdefault((host, template), [0, 0, 0, 0])
            n[3] += 1
            for k in range(3):
                n[k] += b[k]
        for key, (template, parts) in state.items():
            if parts:
                b, n = branch[key[0], template, parts[0]], node[key[0], template]
                apart = differ(b[1], b[0], n[1], n[0]) or differ(b[2], b[1], n[2], n[1])
                wild = n[3] >= 8 and n[3] >= 0.5 * n[0] or not apart and n[3] > 1
                after[key] = (template + "/" + ("*" if wild else parts[0]), parts[1:])
            else:
                after[key] = (template, parts)
        state = after
    return {key: template for key, (template, _) in state.items()}


def brute_urls(rows, rules=urls.RULES):
    """The tree's verdicts in plain Python."""
    parsed = []
    for page, url in rows:
        url = url or ""
        rest = url[url.index("://") + 3 :] if "://" in url else ""
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        parsed.append((page, host, path, best))
    paths = {}
    for _, host, path, rule in parsed:
        p = paths.setdefault((host, path), [0, 0, 0])
        p[0] += 1
        p[1] += rule is not None
        p[2] += rule is not None and rule.verdict == "block"
    cut = lambda path: ["*" if any(c.isdigit() for c in x) else x for x in path.split("/") if x]
    templates = grow_tree(paths, {key: ("", cut(key[1])) for key in paths})
    sums = {}
    for key, template in templates.items():
        t = sums.setdefault((key[0], template), [0, 0, 0])
        for k in range(3):
            t[k] += paths[key][k]
    out = []
    for page, host, path, rule in parsed:
        n, labelled, bad = sums[host, templates[host, path]]
        learned = "block" if (bad + 1) / (labelled + 2) >= 0.9 and labelled >= 0.5 * n else "allow"
        out.append((str(page), host, path, rule.name if rule else None, rule.verdict if rule else learned))
    return sorted(out, key=str)


def judged(spark, rows, rules=urls.RULES):
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns(
        {c: F.lit("?") for c in ("host", "path", "n", "template", "html", "rest", "segment", "shared")}
    )
    found = urls.judge(pages, rules).collect()
    return sorted(((str(r.page_id), r.host, r.path, r.rule, r.verdict) for r in found), key=str)


def test_templates_decide(spark):
    """Most of a template's urls are blocked by rules: those that none fits are blocked too."""
    rules = (urls.Rule("a.com", "/shop/item1", "block"), urls.Rule("a.com", "/good/", "allow"))
    rows = [(k, f"http://a.com/shop/item{100 + k}/buy") for k in range(60)]
    rows += [(100 + k, f"http://a.com/shop/item{20 + k}/buy") for k in range(5)]
    rows += [(200 + k, f"http://a.com/good/{k}") for k in range(20)] + [(300, "http://a.com/other/7")]
    rows += [(400 + k, f"http://a.com/shop/item{30 + k}/read") for k in range(9)]
    got = judged(spark, rows, rules)
    assert got == brute_urls(rows, rules)
    verdicts = {page: (rule, verdict) for page, _, _, rule, verdict in got}
    assert all(verdicts[str(100 + k)] == (None, "block") for k in range(5))
    assert all(verdicts[str(400 + k)] == (None, "allow") for k in range(9))
    assert verdicts["300"] == (None, "allow")


def test_long_urls_take_few_rounds(spark, monkeypatch):
    """Rounds follow branchings, not segments; paths that are used up are not carried on."""
    rounds = []
    kept = urls.written
    monkeypatch.setattr(urls, "written", lambda df, name: rounds.append(name) or kept(df, name))
    deep = "/".join(f"s{chr(97 + k % 26)}" for k in range(500))
    rows = [(1, f"http://h.com/{deep}"), (2, f"http://h.com/{deep}/x"), (3, f"http://h.com/{deep[:600]}/y")]
    rows += [(4, "http://h.com/"), (5, "http://k.com/a/b"), (6, "http://k.com/a/c")]
    assert judged(spark, rows) == brute_urls(rows)
    assert len([r for r in rounds if r.startswith("url-tree")]) <= 4


def test_url_verdicts(spark):
    rows = [
        (1, None), (2, ""), (3, "no scheme"), (4, "http://A.Example.NET/en/x?y#z"), (5, "https://example.net/EN/x"),
        (6, "http://net"), (7, "http://net/"), (8, "http://x.net?q"), (9, "ftp://a.org/fr/1"), (10, "http://a.org/fr"),
        (11, "http://a.example.com/de/5"), (11, "http://a.example.com/de/5"), (None, "http://b.com/1/2/3/4/5/6"),
    ]
    rows += [(100 + k, f"http://a.example.com/{'de' if k % 3 else 'en'}/{k}.html") for k in range(60)]
    rows += [(200 + k, f"http://q.example.com/{'de/' if k % 10 else 'dex/'}{k}") for k in range(50)]
    rows += [(300 + k, f"http://host.com/topic{chr(97 + k % 26)}{chr(97 + k // 26)}/x") for k in range(40)]
    assert judged(spark, rows) == brute_urls(rows)
    assert judged(spark, [(1, None)]) == [("1", "", "", None, "allow")]
    none = spark.createDataFrame([], "page_id long, url string")
    assert urls.judge(none).count() == 0


def test_templates_reject_what_is_mostly_blocked(spark):
    paths = [("h", f"/bad/{k}", 1, 1, 1) for k in range(30)] + [("h", "/bad/new", 1, 0, 0)]
    paths += [("h", f"/good/{k}", 1, 0, 0) for k in range(30)]
    df = spark.createDataFrame(paths, "host string, path string, n long, n_labelled long, n_bad long")
    tree = urls.templates(df)
    found = {r.template: round(r.purity, 3) for r in urls.purity(tree).collect()}
    assert found == {"/bad/*": round(31 / 32, 3), "/bad/new": 0.5, "/good/*": 0.5}


def test_templates_tell_deep_folders_apart(spark):
    paths = [("h", f"/a/b/c/d/e/{'bad' if k % 2 else 'good'}/{k}", 1, k % 2, k % 2) for k in range(60)]
    df = spark.createDataFrame(paths, "host string, path string, n long, n_labelled long, n_bad long")
    found = {r.template: round(r.purity, 3) for r in urls.purity(urls.templates(df)).collect()}
    assert found == {"/a/b/c/d/e/bad/*": round(31 / 32, 3), "/a/b/c/d/e/good/*": 0.5}


def test_nearest_is_exact_enough(spark):
    rng = np.random.default_rng(4)
    vectors = rng.normal(size=(1500, 24)).astype(np.float32)
    vectors[100:140] = vectors[60]  # more copies than neighbours asked for
    vectors[900] = vectors[20]
    rows = [(k, [float(x) for x in v], 0) for k, v in enumerate(vectors)]
    rows += [(2000, None, 0), (2020, [0.0] * 24, 0), (2040, [float("nan")] + [1.0] * 23, 0), (2060, [None] + [1.0] * 23, 0), (2080, [float("inf")] + [1.0] * 23, 0), (2100, [], 0), (None, [1.0] * 24, 0), (7, rows[7][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, size int")
    found = neighbours.nearest(df, F.col("vec_id") % 20 == 0, k=20).collect()
    exact = vectors.astype(np.float64)
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(got) == [k for k in range(0, 1500, 20)]
    hits = 0
    for q, mine in got.items():
        score = (exact * exact[q]).sum(axis=1)
        order = [i for i in np.lexsort((np.arange(1500), -score)) if i != q][:20]
        mine.sort()
        assert [r for r, _, _ in mine] == list(range(1, 21))
        assert all(abs(s - score[i]) < 1e-9 for _, i, s in mine)
        hits += len({i for _, i, _ in mine} & set(order))
        if q in (60, 100, 120):
            assert [i for _, i, _ in mine] == order
    assert hits >= 0.98 * 20 * len(got)
    assert neighbours.nearest(df.limit(0), F.lit(True)).count() == 0
    few = neighbours.nearest(df.where("vec_id in (0, 1, 2)"), F.col("vec_id") == 0)
    assert sorted(r.vec_id for r in few.collect()) == [1, 2]
