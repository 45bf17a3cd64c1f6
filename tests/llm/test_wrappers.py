import html as entities
import itertools
import random
import re

import pytest

from tidemark.llm import wrappers as w
from tidemark.llm.op5_query import op5_html

SF = "/root/testdata/sf0.01"
PAGES = "page_id long, url string, html string"


def plain(page):
    """The tables' pages: one article; blocks begin at h1 and p."""
    found = re.search(r"<article>(.*?)</article>", page or "", re.S)
    blocks = re.split(r"</?(?:h1|p)>", found[1]) if found else []
    blocks = [" ".join(entities.unescape(re.sub(r"<br>", " ", re.sub(r"</?b>", "", b))).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_whole_table_equals_a_plain_reading(spark):
    pages = {r.page_id: (r.url, r.html) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    got = op5_html(spark, SF).collect()
    assert len(got) == len(pages)
    for r in got:
        assert (r.url, r.text, r.n_chars) == (pages[r.page_id][0], plain(pages[r.page_id][1]), len(plain(pages[r.page_id][1])))


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p><article>x</article>";</script></head>
<body class="home"><header><h1>Site</h1></header><nav><ul><li><a href="/a">A</a><li>B</ul></nav>
<div class="cookie-notice">We use cookies</div><div id="page"><main><article class="post">
<header><h1>Title &amp; <i>more</i></h1></header><p>One&nbsp; <b>two</b><br>three<p>Four &lt;5&gt; &eacute;
<div class="adBanner"><p>Buy</div><ul><li>Item 1<li>Item 2</ul>
<form><p>Mail<input></form><!-- <p>no</p> --><blockquote>Quoted</blockquote>
<section id="comments"><article class="comment"><p>Nice</article></section>
</article></main><aside><p>Side</p></aside></div><footer>&copy; me</footer></body></html>"""


@pytest.mark.parametrize("cut", [None, "<footer", "</main>"])
def test_parts_that_are_not_the_article_go(cut):
    page = PAGE if cut is None else PAGE[: PAGE.index(cut)]
    want = ["Title & more", "One two three", "Four <5> é", "Item 1", "Item 2", "Quoted"]
    assert w.blocks_of(page) == want


def test_a_page_without_an_article_keeps_what_is_not_set_aside():
    page = "<body><nav>Menu</nav><div>Text a < b</div><div class='sidebar'>S</div><p>More<footer>F</footer>"
    assert w.blocks_of(page) == ["Text a < b", "More"]


def test_wrappers_match_all_pages_they_come_from():
    item = "<li><a href=x>i</a></li>"
    pages = [
        f"<body><nav><ul>{item * n}</ul></nav>{'<div class=ad>x</div>' if n % 2 else ''}<article><h1>t</h1>"
        + "".join(f"<h2>s</h2>{'<p>x</p>' * (k % 3)}" for k in range(n % 4)) + "</article></body>"
        for n in range(1, 14)
    ]
    shapes = {p: w.shape(w.stream(p)[0]) for p in pages}
    whole, halves = w.infer(set(shapes.values())), [w.infer({shapes[p] for p in pages[a::2]}) for a in (0, 1)]
    for wrapper in (whole, w.infer(halves)):
        letters = w.Alphabet()
        expression = w.Wrapper.of_nodes(w.load(wrapper), letters).expression()
        assert all(expression.fullmatch("".join(map(letters.char, w.stream(p)[0]))) for p in pages)
    assert w.dump(w.load(whole)) == whole


def test_rounds_nulls_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(w, "FAN_IN", 2)
    body = lambda n: "<article>" + "<h2>a</h2>" * (n % 2) + "<p>x</p>" * n + "<ul><li>y</ul>" * (n % 3) + "</article>"
    rows = [(i, "http://a.net/", body(i)) for i in range(12)] + [(12, None, body(3)), (13, "http://a.net/", None), (14, "x", ""),
            (None, "http://b.net", body(2)), (2, "http://a.net/", body(2)), (15, "http://a.net/", "<p>" + "long " * 50_000)]
    pages = spark.createDataFrame([(*r, "z") for r in rows], PAGES + ", host string")
    got = sorted(((r.page_id, r.url, r.text) for r in w.extract(pages).collect()), key=repr)
    assert got == sorted(((i, u, "\n".join(w.blocks_of(h))) for i, u, h in rows), key=repr)
    assert w.wrappers(w.measured(pages)).groupBy("host").count().filter("count > 1").isEmpty()


def test_empty_table(spark):
    assert w.extract(spark.createDataFrame([], PAGES)).count() == 0


def prose(seed, n=30):
    return " ".join(f"w{seed * 7919 % 1000}x{k}" for k in range(n))


def site(i, host="u.org"):
    """A page whose names and tags say nothing: five slots of template, an optional box, and the page's own text."""
    box = "<div class=qd><span>Every third page has this</span></div>" if i % 3 == 0 else ""
    return (
        i, f"http://{host}/{i}",
        f"<html><body class=b{i}><div class=qa>Welcome to us</div><ul class=topbar><li>Home<li>Shop</ul>{box}"
        f"<div class=qb><h2>Title {i}</h2>{''.join(f'<p>{prose(i + 100 * k)}' for k in range(i % 4 + 1))}</div>"
        f"<div class=qc><p>Fixed line</div><div class=legalese>All rights</div></body></html>",
    )


def own(i):
    box = ["Every third page has this"] if i % 3 == 0 else []
    return "\n".join([*box, f"Title {i}", *(prose(i + 100 * k) for k in range(i % 4 + 1))])


@pytest.mark.parametrize("fan_in", [2, 64])
def test_the_wrapper_decides_where_names_say_nothing(spark, monkeypatch, fan_in):
    monkeypatch.setattr(w, "FAN_IN", fan_in)
    rows = [site(i) for i in range(1, 13)]
    alone = [(100 + i, f"http://few.org/{i}", site(i)[2]) for i in (1, 2)]  # too few pages to tell
    copies = [(200 + i, "http://same.org/", site(1)[2]) for i in range(9)]  # one page nine times: nothing differs
    got = {r.page_id: r.text for r in w.extract(spark.createDataFrame(rows + alone + copies, PAGES)).collect()}
    assert {i: got[i] for i in range(1, 13)} == {i: own(i) for i in range(1, 13)}
    for page, _, html in alone + copies:
        assert got[page] == "\n".join(w.blocks_of(html))
        assert "All rights" in got[page] and own(1 if page >= 200 else page - 100) in got[page]


def brute_template(pages):
    """Slots that every page has with one and the same text, straight from the definition."""
    held = [{} for _ in pages]
    for at, page in zip(held, pages):
        for slot in w.stream(page)[1]:
            at.setdefault(slot.path, []).append(slot.text)
    return {path for path in set().union(*held) if len({tuple(h.get(path, ())) for h in held}) == 1}


def test_template_slots_equal_brute_force(spark):
    rows = [site(i) for i in range(1, 10)] + [site(i, "v.org") for i in range(20, 31)]
    got = {r.host: set(r.template) for r in w.template_slots(w.measured(spark.createDataFrame(rows, PAGES))).collect()}
    assert got == {h: brute_template([p for _, u, p in rows if f"/{h}/" in u]) for h in ("u.org", "v.org")}
    assert len(got["u.org"]) == 4


def test_fixed_headings_of_an_article_stay(spark):
    page = "<article><h2>Ingredients</h2><p>{}</p><p class=legal>{}</p><div class=discussion>So {}</div><div class=legal>Terms</div></article>"
    rows = [(i, "http://r.org/", page.format(prose(i), f"Law {i}", i)) for i in range(5)]
    for r in w.extract(spark.createDataFrame(rows, PAGES)).collect():
        assert r.text == f"Ingredients\n{prose(r.page_id)}\nLaw {r.page_id}\nSo {r.page_id}"


def test_a_form_around_the_page_and_headings_of_an_article():
    form = '<form id="aspnetForm"><nav>Menu</nav><div class="cookie">C</div>{}<input></form>'
    article = '<article><div class="article-header"><h1>Title</h1></div><p>Text</p><form><p>Mail</form></article>'
    assert w.blocks_of(form.format(article)) == ["Title", "Text"]
    assert w.blocks_of(form.format(f"<h1>T</h1><p>{prose(1)}")) == ["T", prose(1)]
    assert w.blocks_of(form.format("<p>Name")) == []
    assert w.blocks_of(f"<p>x</p>{form.format('<p>' + prose(2))}") == ["x"]


def test_many_class_names_and_long_pages(spark, monkeypatch):
    flood = "<article>" + "".join(f"<div class='{chr(97 + k % 26)}{'abcdefghij'[k // 26 % 10]}z{'q' * (k // 260)}'>t{k}</div>" for k in range(6_000)) + "</article>"
    assert w.shape(w.stream(flood)[0]) is None
    rows = [(0, "http://f.org/", flood), *((i, "http://f.org/", f"<div class=a>Same</div><p>{prose(i)}") for i in range(1, 6))]
    got = {r.page_id: r.text for r in w.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got[0] == "\n".join(f"t{k}" for k in range(6_000))
    assert all(got[i] == prose(i) for i in range(1, 6))
    monkeypatch.setattr(w.Alphabet, "LAST", w.Alphabet.FIRST + 20)
    assert w.infer([w.shape(f"a{k}" for k in range(n)) for n in (30, 60)])  # letters run out: no error


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
    return row[-1]


def test_common_places_are_a_longest_common_subsequence():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ("".join(rng.choices("abcde", k=rng.randrange(40))) for _ in range(2))
        found = w.common_places(a, b)
        assert len(found) == lcs(a, b) and all(a[i] == b[j] for i, j in found)
        assert all(x[0] < y[0] and x[1] < y[1] for x, y in zip(found, found[1:]))
        with_pieces = list(w.pieces(a, b))
        assert "".join(a[i:j] for _, i, j, _, _ in with_pieces) == a and "".join(b[k:m] for *_, k, m in with_pieces) == b


def test_very_long_pages_of_a_host_have_a_wrapper(spark):
    """What they all require and hold alike is template to them, and not to other pages."""
    names = ["".join(t) for t in itertools.islice(itertools.product("abcdefghijklmnopqrs", repeat=4), 6000)]
    page = "<body><div class='x'>fixed line</div><p>{}</p>{}</body>"
    long = "".join(f'<div class="q{n}"></div>' for n in names)
    rows = [(i, "http://h.org/", page.format(prose(i), long)) for i in range(3)]
    rows += [(3, "http://h.org/", f"<p>{prose(3)}</p>"), (4, "http://h.org/", page.format(prose(4), ""))]
    got = {r.page_id: r.text for r in w.extract(spark.createDataFrame(rows, PAGES)).collect()}
    assert got == {i: prose(i) for i in range(4)} | {4: f"fixed line\n{prose(4)}"}
