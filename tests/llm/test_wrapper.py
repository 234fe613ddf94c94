import random
import time

import pytest

from tallyspan.llm import wrapper


def page(n, body):
    return (
        f'<!DOCTYPE html><html><head><title>T{n}</title><script>var t="</p>";</script><style>p{{}}</style></head><body><nav><a href="/">Home {n}</a></nav>'
        f'<div class="cookie-notice">We use cookies</div><div class="wrap"><p>Our slogan &amp; more</p><h1>Head {n}</h1>{body}<p>All rights kept</p></div>'
        f'<div id="comments"><p>nice {n}</p></div><footer>&copy; {n}</footer></body></html>'
    )


def test_wrapper_drops_constants_and_keeps_slots(spark):
    bodies = {n: f"<p><b>First  {n} text</b> goes<br>on &lt;here&gt;.<p>Second\n {n * 7} part {str(n) * 60}" for n in range(10, 50)}
    rows = [(n, f"https://user@one.example.org:80/{n}", page(n, b), "x") for n, b in bodies.items()]
    rows += [(100, "https://two.example.org/a", page(15, bodies[15]), "x"), (101, None, None, "x"), (102, "junk", "", None), (103, "https://three.example.org", "<p>a < b <p", None), (103, "https://three.example.org", "<p>a < b <p", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, host string")
    got = [(r.page_id, r.text) for r in wrapper.extract(df).collect()]
    assert len(got) == len(rows)
    by = dict(got)
    for n in bodies:
        assert by[n] == f"Head {n}\nFirst {n} text goes on <here>.\nSecond {n * 7} part {str(n) * 60}"
    assert by[100] == f"Our slogan & more\nHead 15\nFirst 15 text goes on <here>.\nSecond 105 part {'15' * 60}\nAll rights kept"  # one page is no template
    assert (by[101], by[102], by[103]) == ("", "", "a < b")
    assert wrapper.extract(df.limit(0)).count() == 0


def test_copies_are_no_template(spark):
    rows = [(n, "http://h.example.org/", page(1, "<p>The very same long article on all pages of this host.</p>") + " " * (n % 2)) for n in range(9)]
    got = wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert all("very same long article" in r.text for r in got)


def test_article_element_wins_and_parser_survives_junk():
    assert wrapper.main_text("<div>out</div><article><h1>A</h1><p>in</article><article class='comment'>no</article>") == "A\nin"
    for junk in ("<", "<a href='", "</p></p>", "<p>" * 400, "<!-- x", "<script>", '<a title="1>2" class=x>t</a>', "&#xZZ; &amp", "<p/><br/>x"):
        wrapper.main_text(junk)
    assert wrapper.main_text('<a title="1>2" class=x>t</a>') == "t"
    big = "<div><p>" + "word " * 200_000 + "</p></div>"
    assert len(wrapper.main_text(big)) == 5 * 200_000 - 1


def test_tree_matching_counts_nodes_in_order():
    a, b = wrapper.parse("<ul><li>1<li>2<li>3</ul><p>x"), wrapper.parse("<ul><li>1<li>3</ul><p>y<p>z")
    assert wrapper.match(a, b) == 1 + 1 + 2 * 2 + 2


def test_deep_nesting_and_long_pages_stay_cheap():
    deep = "<div>" * 5000 + "core" + "</div>" * 5000
    assert wrapper.main_text(deep) == "core"
    long = "<body>" + "".join(f"<p>par {n}</p>" for n in range(3000)) + "</body>"
    made = decided([f"<body><p>tagline</p><p>a{n} {'x' * 50 * n}</p></body>" for n in range(1, 6)])
    assert len(wrapper.main_text(long, made).split("\n")) == 3000


def decided(pages):
    """The wrapper of a few pages, without Spark."""
    seed = wrapper.Wrapper(wrapper.induce(pages))
    made = [seed.digest(p) for p in pages]
    rows, length = [d for d, _ in made], sum(n for _, n in made)
    cols = list(zip(*rows, strict=True))
    return wrapper.Wrapper(seed.decide(len(rows), [sum(c) for c in cols], [sum(v > 0 for v in c) for c in cols], [sum(v == 2 for v in c) for c in cols], length))


def say(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 8))) for _ in range(n))


def plain_page(rng, tagline, body):
    """Nothing but div: links, a teaser that varies, the article, small print."""
    links = "".join(f'<a href="/{k}">{say(rng, 2)}</a>' for k in range(6))
    return f'<html><body><div class="x1">{links}</div><div class="x2">{say(rng, 6)}</div><div class="x3"><p>{tagline}</p><h1>{body[0]}</h1><p>{body[1]}</p><p>{body[2]}</p></div><div class="x4"><p>{tagline} again</p></div></body></html>'


def test_constants_and_slot_decide_where_no_tag_helps(spark):
    """Without the wrapper the template text stays; with it only the slot is left, menu and teaser are not."""
    rng = random.Random(3)
    bodies = [(say(rng, 5), say(rng, 90), say(rng, 70)) for _ in range(60)]
    rows = [(n, f"http://h.example.org/{n}", plain_page(rng, "The paper that everyone reads", b)) for n, b in enumerate(bodies)]
    rows += [(100 + n, "http://h.example.org/x", rows[5][2]) for n in range(300)]  # copies count once
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n, b in enumerate(bodies):
        assert got[n] == "\n".join(b)
        assert wrapper.main_text(rows[n][2]) == "\n".join(("The paper that everyone reads", *b))
    assert got[399] == got[5]


def test_template_is_what_nearly_all_pages_say(spark):
    rng = random.Random(4)
    rows, bodies = [], []
    for n in range(200):
        tagline = "The paper that everyone reads" if n % 50 else "Sorry we are late today"
        body = ("A heading that most pages have" if n % 5 else say(rng, 6), say(rng, 80), say(rng, 60))
        bodies.append((tagline, body))
        rows.append((n, "http://h.example.org/", plain_page(rng, tagline, body)))
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n, (tagline, body) in enumerate(bodies):
        assert got[n] == "\n".join(body if n % 50 else (tagline, *body))


def test_class_names_inside_the_article_and_teasers_beside_it():
    body = "<p>" + "real body text " * 40 + "</p>"
    text = wrapper.main_text(f'<body><article class="teaser-card"><a href="/x">teaser</a></article><div class="text"><h1 class="article-header">Head</h1>{body}<div class="related-topic">kept too</div><div class="comment-list">gone</div></div></body>')
    assert text.split("\n") == ["Head", ("real body text " * 40).strip(), "kept too"]
    assert [wrapper.boiler_name(x) for x in ("ad", "cookie-notice", "comments area", "article-header", "topic related-topic", "")] == [True, True, True, False, False, False]


def test_headline_beside_the_slot_belongs_to_it():
    rng = random.Random(5)
    pages = [f"<body><div class='top'><h1>{say(rng, 4)}</h1></div><div class='main-col'><p>{say(rng, 80)}</p></div></body>" for _ in range(8)]
    made = decided(pages)
    for p in pages:
        head, text = wrapper.main_text(p, made).split("\n")
        assert f"<h1>{head}</h1>" in p and f"<p>{text}</p>" in p


def enumerated(a, b):
    """The most matching nodes, over all ways to match children in order."""
    if (a.tag, a.key) != (b.tag, b.key):
        return 0

    def go(i, j):
        if i == len(a.children) or j == len(b.children):
            return 0
        own = enumerated(a.children[i], b.children[j])
        return max(go(i + 1, j), go(i, j + 1), own + go(i + 1, j + 1) if own else 0)

    return 1 + go(0, 0)


@pytest.mark.parametrize("cells", [4_000_000, 0])
def test_matching_equals_enumeration(monkeypatch, cells):
    """By tables and by halves."""
    monkeypatch.setattr(wrapper, "CELLS", cells)
    rng = random.Random(2)

    def tree(d):
        n = wrapper.Node(rng.choice("ab") if d < 3 else "r", rng.choice(["", "k"]) if d < 2 else "")
        if d:
            n.children = [tree(d - 1) for _ in range(rng.randint(0, 4))]
        return n

    for _ in range(400):
        a, b = tree(3), tree(3)
        pairs = []
        assert wrapper.match(a, b, pairs) == enumerated(a, b) == len(pairs)
        for side in zip(*pairs, strict=True):
            assert len({id(n) for n in side}) == len(pairs)


def test_long_pages_on_both_sides_stay_cheap():
    page = lambda q: "<body><div class=x>" + "".join(f"<p>{q} {i} <b>t</b></p>" if i * q % 7 else f"<p>{i}</p>" for i in range(10_000)) + "</div></body>"
    a, b = wrapper.parse(page(1)), wrapper.parse(page(3))
    began, pairs = time.perf_counter(), []
    assert wrapper.match(a, b, pairs) == len(pairs) > 30_000
    assert time.perf_counter() - began < 10


@pytest.mark.parametrize("tag,text", [("nav", 0), ("div class=ad", 0), ("div", 1), ("section class=cookie", 0)])
def test_deep_elements_of_any_name(spark, tag, text):
    body = "some words that are the text of this page " * 5
    pages = [f"<body><{tag}>" + f"<{tag}>" * 5000 + body + str(n) + f"</{tag.split()[0]}>" * 5001 + f"<p>after {n}</p></body>" for n in range(5)]
    rows = [(n, "http://h.example.org/", p) for n, p in enumerate(pages)]
    got = {r.page_id: r.text for r in wrapper.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    for n in range(5):
        assert (body.strip() in got[n]) == bool(text) and (text or got[n] == f"after {n}")
