"""Pages that are not closed as they should be, or that are built unusually."""

import pytest

from tillbook.llm import html

LONG = "many words in a row, and more of them. " * 9


@pytest.mark.parametrize("source", [
    "<html><head><title>x</title><article><p>kept</p></article>",
    "<html><head><title>x</title><meta charset=a><p>kept",
    "<p>kept <svg width=1 /></p><math/>",
    "<div><button>Go</div><p>kept</p>",
    "<ul><li><select><option>a<option>b</li></ul><p>kept</p>",
    "<div><noscript><img src=x></div><p>kept</p>",
    "<div><object data=x><p>none</div><p>kept</p>",
    "<div><svg><title/><path/></div><p>kept</p>",
    "<div><button>a<button>b</button></div><p>kept</p>",
    "<div><button><script>'</div>'</script>none</button><p>kept</p></div>",
    "<div><template><p>none</div>none</template></div><p>kept</p>",
    "<select><option>none</select><svg><g><text>none</text></g></svg><p>kept</p>",
])
def test_only_what_is_dropped_goes(source):
    assert [text for _, text in html.Page(source).blocks] == ["kept"]


def test_math_is_text():
    page = html.Page("<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><mspace/></math> hold.</p></article>")
    assert [text for _, text in page.blocks] == ["Let x=1 hold."]


@pytest.fixture(scope="module")
def model():
    return html.train([])


def text_of(source, model):
    return html.main_texts([source], model)[0].split("\n\n")


def test_form_around_a_page(model):
    body = f"<h1>Title of it</h1><p>{LONG}</p><p>{LONG}</p>"
    menu = "<ul class=menu><li><a href=/a>A b</a></li><li><a href=/b>C</a></li></ul>"
    page = f"<html><body><form method=post><input type=hidden name=v>{menu}<div id=content>{body}</div><footer>Copyright x</footer></form></body></html>"
    assert text_of(page, model) == ["Title of it", LONG.strip(), LONG.strip()]


def test_footer_of_a_quote_and_aside_with_text(model):
    quote = "<blockquote><p>Said once, and then again by all.</p><footer>A writer of it</footer></blockquote>"
    aside = "<aside><p>An aside that holds what belongs to the article, in some more words.</p></aside>"
    nav = "<nav><a href=/>Home</a></nav>"
    for part, want in ((quote, ["Said once, and then again by all.", "A writer of it"]), (aside, [aside[10:-12]])):
        page = f"<html><body>{nav}<article><h1>Title</h1><p>{LONG}</p>{part}<p>{LONG}</p></article></body></html>"
        assert text_of(page, model) == ["Title", LONG.strip(), *want, LONG.strip()]


@pytest.mark.parametrize("last", ["The last of it, x&amp;y", "The end.", "So it was"])
def test_short_last_paragraph(model, last):
    page = f"<article><h1>T</h1><p>{LONG}</p><p>{last}</p>"
    assert text_of(page, model) == ["T", LONG.strip(), html.html.unescape(last)] == text_of(page + "</article>", model)


def test_maps_and_listings_are_text(model):
    page = f"<article><h1>T</h1><p>{LONG}</p><xmp class=code><b>a</b> &amp; b</xmp><map name=m>On a map, and in words.<area href=x></map><p>{LONG}</article>"
    assert [text for _, text in html.Page(page).blocks] == ["T", LONG.strip(), "<b>a</b> &amp; b", "On a map, and in words.", LONG.strip()]
    assert text_of(page, model) == ["T", LONG.strip(), "<b>a</b> &amp; b", "On a map, and in words.", LONG.strip()]
    assert [text for _, text in html.Page("<p>a<xmp>b <p>c").blocks] == ["a", "b <p>c"]


def test_names_in_other_languages(model):
    menu = "<ul><li><a href=/a>Start</a></li><li><a href=/b>Mehr</a></li></ul>"
    page = (
        f"<body><div class=kopfzeile><a href=/>Zeitung</a>{menu}</div><div class=inhalt><h1>Titel davon</h1><p>{LONG}</p><p>{LONG}</p></div>"
        f"<div class=seitenleiste><h3>Mehr</h3>{menu}</div><div class=fusszeile><p>Copyright und anderes, was unten steht.</p></div></body>"
    )
    assert text_of(page, model) == ["Titel davon", LONG.strip(), LONG.strip()]


def test_repeated_and_very_long_pages(spark):
    long = "<article><h1>T</h1>" + f"<p>{LONG}</p>" * 4000 + "</article>"
    rows = [(1, "u", long), (1, "u", long), (2, "v", f"<article><h1>A</h1><p>{LONG}</p></article>")]
    found = html.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r.page_id, r.n_chars) for r in found) == [(1, len(long.split("<p>")[1][:-4].strip()) * 4000 + 2 * 4000 + 1)] * 2 + [(2, 3 + len(LONG.strip()))]
