import pytest

from candela.llm import html_extraction as H
from candela.llm.common import table
from llm_corpora import SF_ORACLE

SCHEMA = "page_id long, url string, html string, text string, n_chars long"


@pytest.fixture(scope="module")
def model(spark):
    return H.fit(table(spark, SF_ORACLE, "pages"), sample_pages=100, composed_pages=400)


def extract(spark, model, *pages):
    df = spark.createDataFrame([(i, "u", h, "x", 3) for i, h in enumerate(pages)], SCHEMA)
    return {r["page_id"]: r["text"] for r in H.html_extraction(df, model).collect()}


LONG = "Here stands a sentence of some length, with words and commas, that nobody would take for a menu."


def test_layouts(spark, model):
    got = extract(
        spark,
        model,
        f"<html><body><nav><ul><li><a href=x>Home</a><li><a>News</a></ul></nav><article><h1>Title</h1><p>{LONG}<p>A &amp; B&nbsp;&lt;c&gt;\n d</article>"
        f"<div id=comments><div class=comment><p>{LONG}</p></div></div><footer>&copy; me</footer>",
        f"<div class='cookie-notice'><p>{LONG}</p></div><div class='post-content'><p>{LONG}</p><div class='ad'>Buy this now. {LONG}</div>"
        f"<script>var a='</p>'</script><style>p{{}}</style><p>One <b>two</b><br>three</p></div><aside><p>{LONG}</p></aside>",
    )
    assert got[0] == f"Title\n\n{LONG}\n\nA & B <c> d"
    assert got[1] == f"{LONG}\n\nOne two three"


def test_defined_results(spark, model):
    got = extract(spark, model, None, "", "   ", "<html><body></body></html>", "<<<>&#xZZ;</p></div><p", "<div>" * 3000 + "x")
    assert [got[i] for i in range(4)] == ["", "", "", ""]
    empty = spark.createDataFrame([], SCHEMA)
    assert H.html_extraction(empty, model).count() == 0
    assert H.html_extraction(empty, composed_pages=60).count() == 0


def test_decoding_is_consistent_and_best():
    parent, score = [-1, 0, 1, 1, 0, 4], [1.0, -1.0, 3.0, -2.0, -5.0, 4.0]
    assert H.decoded(parent, H.np.array(score)) == [True, True, True, False, False, False]


def test_tree_closes_what_html_closes():
    tree = H.Tree().parsed("<p><b>a<br><p>b<ul><li>c<li>d</ul>e<table><tr><td>f<td>g<tr><td>h</table>")
    pages = H.Pages()
    pages.add(tree)
    assert [b for b in pages.blocks if b] == list("abcdefgh")


def test_articles_of_the_given_pages(spark, model):
    import html
    import re

    rows = table(spark, SF_ORACLE, "pages").select("page_id", "html").collect()
    got = {r["page_id"]: r for r in H.html_extraction(table(spark, SF_ORACLE, "pages"), model).collect()}
    right = 0
    for page, text in rows:
        inner = re.search(r"<article>(.*)</article>", text, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        right += got[page]["text"] == "\n\n".join(b for b in blocks if b)
        assert got[page]["n_chars"] == len(got[page]["text"])
    assert right >= 0.98 * len(rows)


def blocks_of(text):
    pages = H.Pages()
    pages.add(H.Tree().parsed(text))
    return [b for b in pages.blocks if b]


@pytest.mark.parametrize(
    "page",
    [
        "<html><head><title>x</title><body><article><p>a<p>b</article>",
        "<head><meta charset=utf-8><title>x</title><link href=y><article><p>a<p>b</article>",
        "<head><script>s</script><noscript><img src=t>n</noscript><style>s</style><p>a<p>b",
        "<head><title>x</title>\na<p>b",
        "<head><title>x</title><b>a</b><p>b",
        "<head><noscript>n<body><p>a<p>b",
        "<html><head><title>x</title><body><p>a</p></head><p>b",
        "<html><head><title>x</title></head><body><p>a<p>b",
        "<title>x</title><p>a<p>b",
    ],
)
def test_head_ends_without_its_end_tag(page):
    assert blocks_of(page) == ["a", "b"]


def test_pages_without_end_of_head(spark, model):
    got = extract(spark, model, f"<html><head><title>x</title><body><article><h1>T</h1><p>{LONG}<p>{LONG}</article>")
    assert got[0] == f"T\n\n{LONG}\n\n{LONG}"


def test_text_of_math_object_canvas_and_noscript_stays(spark, model):
    inner = f"<p>{LONG} <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds.</p>" + "".join(
        f"<{t}><p>In {t}. {LONG}</p></{t}>" for t in ("object", "canvas", "noscript")
    )
    want = [f"{LONG} x=2 holds.", *(f"In {t}. {LONG}" for t in ("object", "canvas", "noscript"))]
    assert blocks_of(f"<article>{inner}</article>") == want
    got = extract(spark, model, f"<html><head><title>x</title></head><body><article><h1>T</h1><p>{LONG}</p>{inner}<p>{LONG}</p></article></body></html>")
    assert got[0].split("\n\n") == ["T", LONG, *want, LONG]


@pytest.mark.parametrize(
    "inner,want",
    [
        ("See <svg><path/></svg> the icon", "See the icon"),
        ("a <picture><source srcset=x><img src=y></picture> b", "a b"),
        ("a <my-tag>b</my-tag> c", "a b c"),
        ("a <nobr>b</nobr> c", "a b c"),
        ("a <output>b</output> c", "a b c"),
        ("a <object data=x><param name=y>b</object> c", "a b c"),
        ("a <svg><title>t</title><style>s</style><text>b</text></svg> c", "a b c"),
        ("a <audio><source src=x>b</audio> <video>c</video> d", "a b c d"),
        ("a <iframe src=x><p>frame</p></iframe> b", "a b"),
        ("a <select><option>x<div>y</div></select> b", "a b"),
    ],
)
def test_a_block_stays_one_block(inner, want):
    assert blocks_of(f"<article><p>{inner}</p><p>next</p></article>") == [want, "next"]


def test_blocks_of_random_pages():
    """Pages composed with known blocks: inline, unknown, void and silent elements split nothing, blocks do."""
    import random

    rng = random.Random(12)
    inline = ["b", "i", "span", "a", "x-y", "nobr", "font", "svg", "object", "picture", "output", "abbr", "video", "unknown"]
    silent = ["<script>no <p>no</p></script>", "<style>p{no}</style>", "<textarea>no</textarea>", "<iframe>no</iframe>", "<!-- no -->", "<img src=no>", "<template><div>no</div></template>"]
    blocks = ["p", "h2", "li", "blockquote", "div", "figcaption", "td", "dd", "pre", "section"]

    def words(depth):
        parts, said = [], []
        for _ in range(rng.randint(1, 4)):
            kind = rng.random()
            if kind < 0.5 or depth > 3:
                w = f"w{rng.randrange(1000)}"
                parts.append(w)
                said.append(w)
            elif kind < 0.7:
                parts.append(rng.choice(silent))
            else:
                tag = rng.choice(inline)
                own, text = words(depth + 1)
                parts.append(f"<{tag} class=x>{own}</{tag}>")
                said += text
        return " ".join(parts), said

    def page(depth):
        out, want = [], []
        for _ in range(rng.randint(1, 4)):
            tag = rng.choice(blocks)
            if depth < 3 and tag in ("div", "section", "blockquote") and rng.random() < 0.6:
                own, inside = page(depth + 1)
                out.append(f"<{tag}>{own}</{tag}>")
                want += inside
            else:
                own, said = words(0)
                out.append(f"<{tag}>{own}</{tag}>")
                want += [" ".join(said)] if said else []
        return "".join(out), want

    for _ in range(400):
        text, want = page(0)
        assert blocks_of(f"<html><head><title>no</title></head><body>{text}</body></html>") == want, text
