"""URL filter and main-text extraction."""

from flowframe.llm import html_text, url_filter
from flowframe.llm.catalog import QUERIES
from tests.conftest import SF_SMALL

PAGE = "<html><body><nav><a href='/x'>menu</a></nav>{}<footer>foot &copy;</footer></body></html>"


def canonical(url):
    return f"<head><LINK href='{url}' Rel=canonical></head>"


def test_urls_rules_and_aliases(llm):
    rows = [
        (1, "http://A.Example.ORG/en/1x?q#f", ""), (2, "https://example.org/fr/9", None), (3, "https://x.com/de/1", ""),
        # 4 and 5 have no rule and are aliases of a blocked url, 6 of a blocked and an allowed one
        (4, "https://alias.net/a", canonical("https://x.com/de/1")),
        (5, "https://alias.net/b", '<meta content="0; URL=/a" http-equiv="Refresh">'),
        (6, "https://other.net/p/q", canonical("https://y.com/de/2") + canonical("//z.com/fr/3")),
        (7, "https://y.com/de/2", ""), (8, "https://alone.net", "<link rel=stylesheet href=https://x.com/de/1>"),
        (9, "mailto:a@b.org", canonical("https://x.com/de/1")), (10, None, None), (11, "", "<p>"), (None, "https://free.net/?x=//y", ""),
        (12, "https://x.com/de/1", ""), (12, "https://x.com/de/1", ""), (13, "https://notorg/", ""), (14, "https://org", ""),
        (15, "https://loop.net/a/b", canonical("c") + canonical("mailto:x") + canonical("#top")), (16, "https://loop.net/a/c", canonical("https://x.com/de/9")),
    ]
    pages = llm.createDataFrame([(*r, "h", "v") for r in rows], "page_id bigint, url string, html string, host string, verdict string")
    rules = url_filter.rules_table(llm, [*url_filter.RULES, ("b.net/", "block"), ("b.net/", "allow")])
    got = url_filter.filter_urls(pages, rules).collect()
    assert len(got) == len(rows)
    by = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}
    assert by == {
        1: ("a.example.org", "/en/1x", "example.org/en/1", "block"), 2: ("example.org", "/fr/9", "org/", "allow"),
        3: ("x.com", "/de/1", "com/de/", "block"), 4: ("alias.net", "/a", None, "block"), 5: ("alias.net", "/b", None, "block"),
        6: ("other.net", "/p/q", None, "allow"), 7: ("y.com", "/de/2", "com/de/", "block"), 8: ("alone.net", "", None, "allow"),
        9: ("", "", None, "allow"), 10: ("", "", None, "allow"), 11: ("", "", None, "allow"), None: ("free.net", "/", None, "allow"),
        12: ("x.com", "/de/1", "com/de/", "block"), 13: ("notorg", "/", None, "allow"), 14: ("org", "", None, "allow"),
        15: ("loop.net", "/a/b", None, "block"), 16: ("loop.net", "/a/c", None, "block")}
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0
    more = llm.createDataFrame([("https://alone.net/", "http://x.com/de/1")], "a string, b string")
    assert {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages, rules, more_edges=more).collect()}[8] == "block"


def test_relative_links_against_brute_force(llm):
    import random
    from urllib.parse import urljoin

    rng = random.Random(6)
    hosts = ["a.com", "b.net", "c.org"]
    paths = ["/de/1", "/de/x/2", "/fr/1", "/a/b/c", "/a/", "/", "/n/1", "/n/2", "/n/m/3", "/n/m/4"]
    relative = ["../de/1", "../../de/x/2", "./1", "2", "../n/2", "/de/1", "//b.net/n/1", "?q=1", "x/../../n/1", "../../../../de/1", "&#46;&#46;/de/1", "/n/1&amp;2"]
    base_of = ["", "", "", "<base href='/n/m/'>", "<base href='http://a.com/de/'>", "<base target=x>"]
    for _ in range(3):
        rows = []
        for i in range(40):
            url = "https://" + rng.choice(hosts) + rng.choice(paths)
            link = rng.choice(relative)
            tag = rng.choice([f"<link rel=canonical href='{link}'>", f'<meta http-equiv=refresh content="0;url={link}">', ""])
            rows.append((i, url, rng.choice(base_of) + tag, link if tag else None))
        import html as h
        import re

        node = lambda u: u.split("://", 1)[1].split("#")[0]
        judged = {}
        links, nodes = [], set()
        for i, url, page, link in rows:
            nodes.add(node(url))
            if link is not None:
                base = re.search(r"<base href='([^']*)'>", page)
                target = urljoin(urljoin(url, base[1]) if base else url, h.unescape(link))
                links.append((node(url), node(target)))
                nodes.add(node(target))
        from tests.llm.test_dedup import groups

        group = groups(links, nodes)

        def rule(n):
            host, path = n.split("/", 1)
            path = "/" + path.split("?")[0]
            fits = [(r, v) for r, v in url_filter.RULES if (host == r.split("/", 1)[0] or host.endswith("." + r.split("/", 1)[0]))
                    and path.startswith("/" + r.split("/", 1)[1])]
            return max(fits, key=lambda x: len(x[0]))[1] if fits else None

        for n in nodes:
            v = rule(n)
            if v:
                judged.setdefault(group[n], set()).add(v)
        want = {}
        for i, url, *_ in rows:
            passed = judged.get(group[node(url)], set())
            want[i] = rule(node(url)) or ("allow" if "allow" in passed or not passed else "block")
        pages = llm.createDataFrame([r[:3] for r in rows], "page_id bigint, url string, html string")
        got = {r["page_id"]: r["verdict"] for r in url_filter.filter_urls(pages, url_filter.rules_table(llm, url_filter.RULES)).collect()}
        assert got == want and "block" in want.values()


def test_blocks_and_boilerplate():
    article = ("<article><h1>Title &amp; more</h1><p><b>First\n  par<i>a</i>graph.<br>same block<p>Second &lt;one&gt;<div class='share-bar'>tweet</div>"
               "<script>var t='</p>'</script><!-- gone --><ul><li>point one<li>point <a href=#>two</a></ul><form>mail<input></form>"
               "<aside>side</aside><section class=comments><p>great post</p></section><p hidden>no</p><p>&nbsp;</p><p>Last</article>")
    assert html_text.extract(PAGE.format(article), "body>article") == (
        "Title & more\nFirst paragraph. same block\nSecond <one>\npoint one\npoint two\nLast")
    assert html_text.extract(PAGE.format("<div id=main><p>" + "text " * 50 + "</p></div><div class='ad ad7'>buy</div>")) == ("text " * 50).strip()
    for page in ("", "   ", "<html></html>", "<!-- never closed", "<script>x", "<p", "<style>p{}</style>", "<nav>only menu</nav>"):
        assert html_text.extract(page) == ""
    assert html_text.extract("plain & simple") == "plain & simple"
    assert html_text.extract("<p>a</p>" * 20_000).count("\n") == 19_999


def test_class_names_do_not_lose_the_article():
    body = "<h1>Title</h1><p>" + "real words here " * 20 + "</p>"
    want = "Title\n" + ("real words here " * 20).strip()
    for name in ("content no-sidebar", "has-sidebar", "with-header", "elementor-widget", "col reply-free", "related", "site-banner promo"):
        assert html_text.extract(PAGE.format(f"<div class='{name}'><article>{body}</article></div>")) == want
        if name not in ("col reply-free",):
            assert html_text.extract(PAGE.format(f"<div class='{name}'>{body}</div><div class=more><p>few</p></div>")).startswith(want)
    assert html_text.extract(PAGE.format(f"<article><header class=entry-header><h1>Title</h1></header>{body[14:]}</article>")) == want
    comments = "<section class=comments><article class=comment><p>" + "great post " * 90 + "</p></article></section>"
    assert html_text.extract(PAGE.format(f"<article>{body}</article>{comments}")) == want
    assert html_text.extract(PAGE.format(f"<article>{body}{comments}</article>")) == want
    assert html_text.extract(PAGE.format(f"<article>{body}<p>so <math><mi>x</mi><mo>=</mo><mn>1</mn></math> holds</p><noscript><p>still</p></noscript></article>")) == (
        want + "\nso x=1 holds\nstill")


def test_hostile_pages_take_linear_time():
    import time

    size = 1 << 20
    pages = ["<a x" * (size // 4), "<script " * (size // 8), "<a x='" * (size // 6), "<a <a \"" * (size // 7) + ">", "<div>" * (size // 5) + "</x>" * (size // 4),
             "<!--" * (size // 4), "</" * (size // 2), "<p \"'" * (size // 5) + ">>", "<b>" * (size // 6) + "x</i>" * (size // 10), "<" * size]
    for page in pages:
        began = time.process_time()
        html_text.extract("<article><p>whole</p></article>" + page)
        assert time.process_time() - began < 6, page[:12]
    assert html_text.extract("<article><p>whole</p></article>" + pages[0]) == "whole"
    assert html_text.extract("<div>" * 3000 + "<p>deep text</p>") == "deep text"
    assert html_text.extract("<p class=\"x>never closed</p><p>more") == "never closed\nmore"


def brute_winner(pages):
    """The path of most votes over all pages of a host, ties to the one that sorts first, climbed."""
    total, around = {}, {}
    for page in pages:
        found = html_text.blocks(page)
        for path, v in html_text.votes(found).items():
            total[path] = total.get(path, 0.0) + round(v, 3)
        for path, sizes in html_text.spans(found).items():
            around[path] = tuple(x + y for x, y in zip(around.get(path, (0, 0, 0)), sizes))
    return html_text.climb(min(total, key=lambda k: (-total[k], k)) if total else None, around)


def test_host_votes_against_brute_force(llm):
    import random

    rng = random.Random(8)
    rows, by_host = [], {}
    for host in ("a.net", "b.net", "c.net"):
        for i in range(9):
            parts = [f"<div class='{rng.choice(['post', 'text', 'feed'])}{rng.choice(['', ' x1', ' x2'])}'><p>{'word ' * rng.randint(1, 60)}</p>"
                     f"<section class=s{rng.randint(1, 9)}><p>{'more ' * rng.randint(0, 60)}</p></section></div>" for _ in range(rng.randint(1, 4))]
            page = PAGE.format("".join(parts))
            rows.append((f"{host}{i}", f"https://{host}/{i}", page))
            by_host.setdefault(host, []).append(page)
    got = html_text.extract_pages(llm.createDataFrame(rows, "page_id string, url string, html string")).collect()
    want = {}
    for host, pages in by_host.items():
        path = brute_winner(pages)
        want |= {f"{host}{i}": html_text.extract(page, path) for i, page in enumerate(pages)}
    assert {r["page_id"]: r["text"] for r in got} == want


def test_hosts_vote_for_a_path(llm):
    good = "<div class='post p{0}'><p>" + "real words here " * 20 + "{0}</p></div><div class=feed><p>{1}</p></div>"
    rows = [(i, f"https://h.net/{i}", PAGE.format(good.format(i, "tease " * (300 if i == 3 else 10)))) for i in range(8)]
    rows += [(20, "https://h.net/odd", PAGE.format("<article><p>other template</p></article>")), (21, None, None), (22, "https://n.net/", ""),
             (None, "https://h.net/0", None), (23, None, "<p>no host</p>"), (23, None, "<p>no host</p>")]
    pages = llm.createDataFrame([(*r, "x", "y") for r in rows], "page_id bigint, url string, html string, path string, text string")
    got = html_text.extract_pages(pages)
    assert got.columns == ["page_id", "url", "text"]
    texts = {r["page_id"]: r["text"] for r in got.collect()}
    assert got.count() == len(rows)
    # page 3 alone would have chosen its teasers
    assert html_text.extract(rows[3][2]).startswith("tease") and texts[3] == ("real words here " * 20 + "3")
    assert texts[20] == "other template" and texts[21] == texts[22] == texts[None] == "" and texts[23] == "no host"
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_nested_and_sibling_sections_stay_whole(llm):
    long, lead, extra = "long section text " * 40, "the lead " * 5, "other wrapper " * 20
    want = "\n".join(x.strip() for x in ("Title", lead, long, extra))
    inner = f"<h1>Title</h1><p>{lead}</p><div class=section><p>{long}</p></div><div class=more><p>{extra}</p></div>"
    links = "<div class=teasers><p><a href=/1>" + "teaser " * 30 + "</a></p></div>"
    kinds = {"article.net": f"<article>{inner}</article>{links}", "div.net": f"<div class=story>{inner}</div>{links}",
             "deep.net": f"<main><div class=a><div class=story>{inner}</div></div>{links}</main>", "body.net": inner.replace("more", "section")}
    rows = [(f"{host}{i}", f"https://{host}/{i}", PAGE.format(page)) for host, page in kinds.items() for i in range(3)]
    got = html_text.extract_pages(llm.createDataFrame(rows, "page_id string, url string, html string")).collect()
    assert {r["page_id"]: r["text"] for r in got} == {r[0]: want for r in rows}
    assert all(html_text.extract(r[2]) == want for r in rows)


def test_query_extracts_the_article_of_every_page(llm):
    import html
    import re

    pages = {r["page_id"]: r["html"] for r in llm.read.parquet(f"{SF_SMALL}/pages.parquet").collect()}
    rows = QUERIES["op10_html_extraction"](llm, SF_SMALL).collect()
    assert len(rows) == len(pages)
    for r in rows:
        article = re.search(r"<article>(.*?)</article>", pages[r["page_id"]], re.S)[1]
        parts = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1)>", article))
        assert r["text"] == "\n".join(x for x in parts if x) and r["n_chars"] == len(r["text"])
