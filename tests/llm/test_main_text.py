"""Main text of hand-made pages, parts that belong to it, and the DataFrame operator's edges."""

import time

import pytest

from cofferline.llm import html_text, queries

LONG = "A sentence of the article, with commas, " * 8
MORE = "Another part of it, as long as needed, " * 4


@pytest.mark.parametrize(
    ("page", "want"),
    [
        # a second article and a part that goes on beside it
        (f"<body><article><p>{LONG}</p></article><article><p>{MORE}</p></article><div>It ends here.</div></body>", [LONG, MORE, "It ends here."]),
        # the body itself is the best container: its link lists go
        (f"<body><p>{LONG}</p><div><a href=/>Home page link</a> <a href=/c>Contact us link</a></div><p>{MORE}</p></body>", [LONG, MORE]),
        # a word of furniture around the article
        (f"<body><div class='search-history'><p>{LONG}</p><p>{MORE}</p></div><div class=footer>The foot</div></body>", [LONG, MORE]),
        # and beside it
        (f"<body><div><p>{LONG}</p><div class='related'><p>{MORE[:60]}</p></div></div></body>", [LONG]),
        (f"<body><div aria-label='newsletter'>Sign up, please, to read more of this</div><p>{LONG}</p></body>", [LONG]),
        # reader comments go, however long
        (f"<body><div><p>{MORE}</p></div><div class=comments><p>{LONG}</p><p>{LONG}</p></div></body>", [MORE]),
        # empty comments end at once, others at their end
        (f"<!--><p>{LONG}</p>", [LONG]),
        (f"<!---><p>{LONG}</p><!-- <p>no</p> --!><p>{MORE}</p>", [LONG, MORE]),
        # implied ends
        (f"<div><p>{LONG}<p>{MORE}<ul><li>one<li>two</ul></div>", [LONG, MORE, "one", "two"]),
        (f"<table><tr><td>{LONG}<td>b<tr><td>{MORE}</table>", [LONG, "b", MORE]),
        ("", []),
        ("&lt;no tags&gt;  at\nall", ["<no tags> at all"]),
    ],
)
def test_parts(page, want):
    assert html_text.main_text(page) == "\n\n".join(" ".join(part.split()) for part in want)


@pytest.mark.parametrize(
    "page",
    ["<b>" * 8000 + "</b>" * 8000 + "</i>" * 8000, "<i><div>" + "<b>" * 8000 + "</i>" * 8000, "<h1>" * 8000, "<div>" * 50_000 + "text", "<p>" * 9000, "<table>" + "<tr><td>x" * 8000],
)
def test_deep_pages_take_linear_time(page):
    began = time.process_time()
    html_text.main_text(page)
    assert time.process_time() - began < 2


def test_query_on_odd_rows(spark, tmp_path):
    page = f"<body><nav>menu</nav><p>{LONG}</p></body>"
    rows = [(1, "u", page, "old"), (2, None, None, "old"), (3, "u", "", None), (None, "u", page, None), (1, "u", page, "old"), (4, "", "x" * 300_000, None)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string, text string")
    df.write.parquet(f"{tmp_path}/pages.parquet")
    got = sorted(((r.page_id is None, r.page_id or 0, r.text, r.n_chars) for r in queries.op2_main_text(spark, str(tmp_path)).collect()))
    text = " ".join(LONG.split())
    long = "x" * 300_000
    assert got == [(False, 1, text, len(text)), (False, 1, text, len(text)), (False, 2, "", 0), (False, 3, "", 0), (False, 4, long, 300_000), (True, 0, text, len(text))]
    out = html_text.extract_main_text(df)
    assert out.columns == df.columns
    assert html_text.extract_main_text(df.limit(0)).count() == 0
