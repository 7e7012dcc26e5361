"""Pages by built-in functions against the standard library's parser."""

from html.parser import HTMLParser

import pytest

from docketry.sources import tables as S


class Page(HTMLParser):
    """Title, visible text and table cells of a page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.title, self.text, self.tables, self.hidden, self.in_title, self.cell, self.links = [], [], [], 0, False, None, 0

    def handle_starttag(self, tag, attrs):
        if tag in ("script", "style"):
            self.hidden += 1
        elif tag == "title":
            self.in_title = True
        elif tag == "table":
            self.tables.append({"rows": []})
        elif tag == "tr" and self.tables:
            self.tables[-1]["rows"].append([])
        elif tag in ("td", "th") and self.tables and self.tables[-1]["rows"]:
            self.cell = []
        elif tag == "a":
            self.links += 1
        if tag in ("p", "br", "div", "li", "tr", "h1", "h2", "h3"):
            self.text.append("\n")

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self.hidden = max(0, self.hidden - 1)
        elif tag == "title":
            self.in_title = False
        elif tag in ("td", "th") and self.cell is not None:
            self.tables[-1]["rows"][-1].append(" ".join("".join(self.cell).split()))
            self.cell = None

    def handle_data(self, data):
        if self.in_title:
            self.title.append(data)
        elif not self.hidden:
            self.text.append(data)
            if self.cell is not None:
                self.cell.append(data)


def parsed(html):
    p = Page()
    p.feed(html or "")
    p.close()
    lines = (" ".join(x.split()) for x in "".join(p.text).split("\n"))
    return " ".join("".join(p.title).split()), "\n".join(x for x in lines if x), p.tables, p.links


def as_rows(df):
    return {r["page_id"]: (r["title"], r["text"], [{"rows": t["rows"]} for t in r["tables"]], r["links"]) for r in df.collect()}


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_all_pages(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    got = as_rows(S.html_snapshots(pages, "html", ["page_id"]))
    assert got == {r["page_id"]: parsed(r["html"]) for r in pages.select("page_id", "html").collect()}


PAGES = [
    "", None, "plain & simple", "<title>A &amp; B</title>x", "<p>one<p>two<br>three", "<script>if (a < b) x()</script>after", "<style>p > a {}</style><div>t</div>", "<!-- <p>no</p> -->yes",
    "<table><tr><th>a<td>b</td></tr><tr><td>c &lt; d</td><td>e<b>f</b></td></tr></table>", "<td>loose</td>", "<table><tr><td>o<table><tr><td>i</td></tr></table>x</td></tr></table>", "<a href='x>y'>l</a><A>m</A><abbr>n</abbr>", "1 &lt; 2 &#233; &#x1F600; &eacute; &nbsp;end", "a < b and 3<4", "<h1>T</h1><ul><li>x<li>y</ul>",
    "<!DOCTYPE html><html><head><title> two\n words </title></head><body>b</body></html>", "<table><tr><td> a\n b </td></tr></table><table><tr></tr></table>",
]


def test_cases(spark):
    df = spark.createDataFrame(list(enumerate(PAGES)), "page_id int, html string")
    assert as_rows(S.html_snapshots(df, "html", ["page_id"])) == {i: parsed(x) for i, x in enumerate(PAGES)}
