"""Anchors as browsers read them."""

from obligato.sources import links as L


def test_anchor_forms(spark):
    html = """<A class=x HREF='/a.xlsx'>Upper <b>case</b></A> <a
      href = "b.xls?x=1&amp;y=2"
      target=_blank>two
      lines</a><a href=http://h/c.xlsx>bare</a> <a name="n">no link</a> <a href="">empty</a>
      <abbr title="x">not an anchor</abbr> <a data-href="no" href="/d">T&amp;C &lt;now&gt;</a>"""
    df = spark.createDataFrame([(1, "http://site/dir/page.html?q", html)], "page_id long, url string, html string")
    got = [(r.link_ord, r.href, r.text) for r in L.anchors(df).orderBy("link_ord").collect()]
    assert got == [(1, "/a.xlsx", "Upper case"), (2, "b.xls?x=1&y=2", "two lines"), (3, "http://h/c.xlsx", "bare"),
                   (4, "", "empty"), (5, "/d", "T&C <now>")]
    urls = [r.url for r in L.harvest_links(df).orderBy("link_ord").collect()]
    assert urls == ["http://site/a.xlsx", "http://site/dir/b.xls?x=1&y=2", "http://h/c.xlsx"]
