"""Plainly written pages are cut at their tags, without the tolerant parser and with its rows."""

import random

import pytest

from cofferline.sources import pages

PLAIN = [
    "<table>", '<table id="js-chain-table">', "<TABLE ID=js-chain-table class='a>b'>", "</table>", "<tbody>", "</tbody>",
    "<tr>", "</tr>", "<td>", "<td class=x>", "</td>", "<td> 1 &lt; 2 </td>", '<a href="/x?a=1&amp;b">', "<a>", "<a href>",
    "<a HREF='q'  href=\"z\">", "</a>", "a &amp; b", "<b>", "</b>", "<br/>", "<!-- c -->", "<script>x &amp; y</script>",
    "<style>t</style>", "<title>a &amp; b</title>", "<!DOCTYPE html>", "\n",
]
ODD = ["<", "&", "<td/>", "<!-- a<td>b -->", "<script>a<td></script>", '<td a="<">', "</td x>", "<textarea>", "<?pi?>", "<!-->", "</script>"]
START = '<table id="js-chain-table"><tbody><tr><td>'


def _parsed(html, table_id, body_only):
    parser = pages._Table(table_id, body_only)
    parser.feed(html)
    parser.close()
    return parser.rows


@pytest.mark.parametrize("piece", [1, 17, 1 << 18])
def test_rows_equal_those_of_the_parser(monkeypatch, piece):
    monkeypatch.setattr(pages, "_PIECE", piece)
    draw, read = random.Random(piece), 0
    for at in range(3_000):
        html = START * (at % 2) + "".join(draw.choices(PLAIN + ODD * (at % 3 == 0), k=draw.randint(0, 25)))
        for asked in ((None, False), (pages.PORTFOLIO_TABLE_ID, True)):
            found = pages._plain_rows(html, *asked)
            assert found is None or found == _parsed(html, *asked), html
            assert pages._rows_of(html, *asked) == _parsed(html, *asked), html
            read += found is not None
    assert read > 3_000


def test_plain_pages_do_not_go_through_the_parser(monkeypatch):
    monkeypatch.setattr(pages._Table, "feed", None)
    html = START + ' x </td><td><a href="/t/1?a=2"><b>y</b></a></td></tr></tbody></table>'
    assert pages._rows_of(html, pages.PORTFOLIO_TABLE_ID, True) == [[[" x ", None], ["y", "/t/1?a=2"]]]
