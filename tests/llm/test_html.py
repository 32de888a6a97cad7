"""Main text of hand-made pages and of the whole table."""

from lotforge.llm.lineblocks import extract, main_text, stretches
from lotforge.llm.queries import queries

SF = "/root/testdata/sf0.001"
PAGE = """<!doctype html><html><head><title>No</title><style>p{}</style><script>var a = "<p>no</p>";</script></head>
<body><nav><a href="/">Home</a></nav><div class="cookie-notice">We use cookies</div>
<article><h1>A &amp; B</h1><p>First   line
goes &lt;on&gt;</p><div class="ad">Buy now</div><p>Second&nbsp;one <b>bo</b>ld.</p><form><input value=1>Go</form></article>
<section class="comments"><p>Nice text, reader says.</p></section><aside>More</aside><footer>(c)</footer></body></html>"""


def test_marked_article():
    assert main_text(PAGE) == "A & B\nFirst line goes <on>\nSecond one bold."


def test_unmarked_article_is_the_densest_stretch():
    body = "".join(f"<p>{'long sentence of the article ' * 8}{i}</p>" for i in range(5))
    page = f"<body><div class=menu><a>x</a></div><div>{body}</div><div><a href=a>one</a> <a href=b>two</a></div></body>"
    lines = main_text(page).split("\n")
    assert len(lines) == 5 and all(line.startswith("long sentence") for line in lines)


def test_broken_and_empty_pages():
    assert main_text(None) == main_text("") == main_text("<p") == ""
    assert main_text("<article><p>open <b>ends") == "open ends"
    assert main_text("<article><p>" + "w " * 300_000 + "</article>").count("w") == 300_000


def test_surge_and_dive():
    assert list(stretches([0, 0, 0, 0, 5, 2, 0, 0, 0, 0, 7])) == [(2, 6), (8, 11)]
    assert list(stretches([])) == []


def test_rows(spark):
    rows = [(1, "u", PAGE, "t"), (1, "u", PAGE, "t"), (None, None, None, "t"), (2, "v", "", "t")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = extract(frame).collect()
    assert sorted(r["n_chars"] for r in got) == [0, 0, len(main_text(PAGE)), len(main_text(PAGE))]
    assert extract(frame.limit(0)).count() == 0


def test_whole_table(spark):
    got = queries()["op1_line_blocks"](spark, SF).collect()
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert len(got) == len(pages)
    for r in got:
        assert r["text"] == main_text(pages[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert "<script" not in r["text"] and all(line == " ".join(line.split()) for line in r["text"].split("\n"))


def test_unmarked_article_with_blocks_inside():
    long, short = "letters of the article " * 130, "a short ending of the same article"
    linked = '<p><a href="r">The report that this article is about</a></p>'
    inside = f"<h1>Title</h1><div class=share>Share</div><p>{long}</p><div class=ad>Buy</div>{linked}<div class=ad>Buy</div><p>{short}</p>"
    text = f"Title\n{long.strip()}\nThe report that this article is about\n{short}"
    far = "<div class=ad>x</div><div><p>Imprint of the site</p></div><ul><li><a href=a>Archive</a></ul>"
    for page in (f"<div>{inside}</div>{far}", f"<body><div><div>{inside}</div></div>{far}</body>", f"<body>{inside}{far}</body>"):
        assert main_text(page) == text
    table = f"<table><tr><td><p><a href=a>Menu</a></p></td><td>{inside}</td></tr></table>"
    assert main_text(table) == text
    parts = "".join(f"<p>{c * 300}</p><div class=ad>x</div>" for c in "abcd")
    other = f"<div><div class=ad>x</div><p>{'z' * 500}</p></div>"
    assert main_text(f"<div>{parts}<h2>End</h2></div>{other}").split("\n")[4:] == ["End", "z" * 500]
    assert main_text("<div>" * 3000 + inside + "</div>" * 3000) == text
