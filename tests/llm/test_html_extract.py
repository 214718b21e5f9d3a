"""Held-out layouts, markup of all kinds, linear time and edge rows."""
import pytest

from wxodds.llm import html_extract as H
from wxodds.llm import labelled_pages as L


@pytest.fixture(scope="module")
def field():
    return H.default_field()


def test_labelled_pages_of_another_seed(field):
    wrong = total = 0
    for page in L.pages(3, seed=77):
        known = H.training_blocks(page)
        for (_, y), got in zip(known, H.decode(field, [b for b, _ in known]), strict=True):
            wrong, total = wrong + (y != got), total + 1
    assert wrong <= 0.01 * total


def test_layouts_left_out_of_training(monkeypatch):
    wrong = total = 0
    layouts = L.LAYOUTS
    for k in range(0, len(layouts), 3):
        monkeypatch.setattr(L, "LAYOUTS", layouts[:k] + layouts[k + 1:])
        other = H.train(L.pages(4), 150)
        monkeypatch.setattr(L, "LAYOUTS", layouts[k:k + 1])
        for page in L.pages(4, seed=8):
            known = H.training_blocks(page)
            for (_, y), got in zip(known, H.decode(other, [b for b, _ in known]), strict=True):
                wrong, total = wrong + (y != got), total + 1
    assert wrong <= 0.15 * total


def test_viterbi_is_the_likeliest_path(field):
    blocks = H.blocks(L.pages(1)[3].replace("[+]", "").replace("[-]", ""))[:10]
    score = [sum(field.weights.get(f, 0.0) for f in b.features) for b in blocks]
    best = max((sum(s for s, y in zip(score, ys, strict=True) if y) + sum(field.turn[2 * a + b] for a, b in zip(ys, ys[1:])), ys)
               for ys in ([int(c) for c in f"{k:0{len(blocks)}b}"] for k in range(2 ** len(blocks))))
    assert H.decode(field, blocks) == [bool(y) for y in best[1]]


def test_page(field):
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{a:b}</style><script>if (a<b) document.write("<p>No</p>")</script></head>
    <body><nav><a href="/">Home</a></nav><!-- <p>No</p> --><article><h1>A title &amp; more</h1><p>First
    paragraph,\tof&nbsp;two <b>lines<br>here</b>.<p>Second &lt;one&gt; &#233;&eacute;.</p><div class="ad">Buy this now!</div>
    <p style="display:none">No</p><p>Third <a href="x">with a link</a> in it.</p><section class="comments"><p>Nice, I liked it a lot.</p></section>
    </article><form><p>Sign up for more.</p><input value="No"><textarea>No</textarea></form><footer>&copy; No</footer></body></html>"""
    assert H.main_text(field, page) == ("A title & more\nFirst paragraph, of two lines here.\nSecond <one> éé.\n"
                                        "Third with a link in it.")


HIDES = ["hidden", "HIDDEN", "hidden=''", "hidden class='x'", "class='x'hidden", "aria-hidden=true", "aria-hidden = 'true'",
         "style='color:red; display : none'", 'style="display:none !important"', "title='a \"b\"' hidden"]
SHOWS = ["title='Our hidden valleys'", 'title="Our hidden valleys"', "class='prose hidden md:block'", "data-a='x' title=' hidden '",
         "data-style='display:none'", "title='display:none'", "alt='aria-hidden=true'", "aria-hidden='false'", "data-hidden='1'",
         "title='class=\"x\" hidden '", "style='display:block'", "href=/x/hidden", "title=\"it's hidden now\"", "title='my id=\"footer\" hidden '"]


@pytest.mark.parametrize("attributes", HIDES + SHOWS)
def test_hidden_is_an_attribute_not_a_word_of_a_value(field, attributes):
    whole = "First paragraph, with a part of it, in one sentence."
    inner = f"<article><p>First paragraph, <span {attributes}>with a part of it,</span> in one sentence.</p></article>"
    outer = f"<article {attributes}><p>{whole}</p></article>"
    if attributes in SHOWS:
        assert H.main_text(field, inner) == whole and H.main_text(field, outer) == whole
    else:
        assert H.main_text(field, inner) == "First paragraph, in one sentence." and H.main_text(field, outer) == ""


@pytest.mark.parametrize("tag", sorted(H.RAW - H.TO_END))
def test_an_element_without_its_end_takes_no_text_with_it(field, tag):
    first, second = "First paragraph, of some words in a row.", "Second paragraph, after the open element."
    for start in (f"<{tag}>", f"<{tag} class='x'>", f"<{tag.upper()} data-a='1'>"):
        page = f"<article><p>{first}</p>{start}<p>{second}</p></article>"
        assert H.main_text(field, page) == f"{first}\n{second}"
        assert H.main_text(field, page + f"<nav><{tag}>x</{tag}></nav>") == f"{first}\n{second}"     # the end is another one's
        assert H.main_text(field, f"<article><p>{first[:16]}{start}{first[16:]}</p></article>") == first
        assert H.main_text(field, f"<article><p>{first}{start}No</{tag}></p><p>{second}</p></article>") == f"{first}\n{second}"


def test_formulas_and_objects_are_text(field):
    page = ("<article><p>Let <math display='inline'><mi>x</mi><mo>=</mo><msup><mi>y</mi><mn>2</mn></msup></math> hold for all of them.</p>"
            "<p>The chart <object data='a.svg'>shows steady growth</object> over the year.</p></article>")
    assert H.main_text(field, page) == "Let x=y2 hold for all of them.\nThe chart shows steady growth over the year."


def test_deep_pages_know_all_their_ancestors(field):
    for deep in ("<div>" * 150, "<font>" * 250):
        page = f"<section class='comments'>{deep}<p>Nice, I liked it a lot, thanks.</p>"
        assert {"in section", "hint comment", "near comment"} <= set(H.blocks(page)[0].features)
        page = f"<article>{deep}<p>One sentence of some words here.</p></article><nav><p>Out.</p></nav>" * 2
        assert ["in article" in b.features for b in H.blocks(page)] == [True, False] * 2
    items = [b.features for b in H.blocks("<ul><li class='ad'>" + "<font>" * 30 + "One<li>Two</ul>")]
    assert "hint ad" in items[0] and "hint ad" not in items[1]


def test_many_open_elements_in_linear_time(field):
    for tag in H.RAW:
        H.main_text(field, f"<{tag}>" * 30_000)
        H.main_text(field, f"<{tag}>x</{tag}>" * 30_000)


@pytest.mark.parametrize("page", ["", None, "   ", "<", "<>", "</p>", "<p", "<!--", "<script>", "<nav><a href='/'>x</a></nav>"])
def test_nothing(field, page):
    assert isinstance(H.main_text(field, page), str)


def test_long_and_broken_pages(field):
    for page in ("<" * 100_000, '<a "' * 30_000, "<!--" * 30_000, "<script>" * 30_000, "<div>x" * 20_000, "</p>" * 50_000,
                 "<p hidden>" * 20_000, "&amp" * 50_000, '<a href="' * 30_000):
        H.main_text(field, page)
    long = "<article>" + "<p>A sentence of some words, and a mark.</p>" * 20_000 + "</article>"
    assert H.main_text(field, long).count("\n") == 19_999


def test_spark(spark):
    rows = [(1, "u", "<article><p>One sentence here, all of it.</p></article>", "old"), (1, "u", None, "old"), (None, None, "", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    assert sorted(r.text for r in H.extract(df).collect()) == ["", "", "One sentence here, all of it."]
    assert H.extract(df.limit(0)).count() == 0
