"""Anchors as an HTML parser finds them."""

import pytest

from quarry.sources.links import first_link_with_text, unescape

TEXT = "Download the index"
CASES = [
    ("<a href='u'>Download the index</a>", "u"),
    ("<A HREF='u'>Download the index</A>", "u"),
    ("<a href=u>Download the index</a>", "u"),
    ("<a class=x href = 'sp' id=y>Download the index</a>", "sp"),
    ("<!-- <a href='no'>Download the index</a> --><a href='u'>Download the index</a>", "u"),
    ("<a data-href='no' href='u'>Download the index</a>", "u"),
    ("<a data-href='no'>Download the index</a>", None),
    ("<a href='a&#x2F;b&#47;c&amp;d&lt;&quot;'>Download the index</a>", 'a/b/c&d<"'),
    ("<a href='say \"u\"'>Download the index</a>", 'say "u"'),
    ("<a title='>' href=\"it's\">Download the index</a>", "it's"),
    ("<a title=\"href='no'\" href=u>Download the index</a>", "u"),
    ("<a href=one href=two>Download the index</a>", "two"),
    ("<a href=u>Download&#32;the index</a>", "u"),
    ("<a href=u>&amp;Download the index</a>", None),
    ("<a href=u><b><i>Download the index</i></b></a>", "u"),
    ("<a href=u><b>Download</b> the index</a>", None),
    ("<a href=u>Download the index<br></a>", None),
    ("<a href=u>Download the index<!-- x --></a>", None),
    ("<a href=u> Download the index</a>", None),
    ("<script>var s = \"<a href='no'>Download the index</a>\"</script><a href=u>Download the index</a>", "u"),
    ("<a href=no>other</a><a href=u>Download the index</a><a href=v>Download the index</a>", "u"),
    ("<p><a href=u>Download the index</p><p>more", "u"),
    ("<a href=u>Download the index", "u"),
    ("<a href=u><b>Download the index</a></b>", "u"),
    ("<a href=out><a href=in>Download the index</a></a>", "out"),
    ("<a href=out>x<a href=in>Download the index</a></a>", "in"),
    ("</b></a><a href=u></i>Download the index</a>", "u"),
    ("<a href=u>Download the index</a", None),
    ("1 < 2 <a href=u>Download the index</a> 3 > 2", "u"),
    ("<abbr href=no>Download the index</abbr>", None),
    ("<a>Download the index</a>", None),
    ("<a href=''>Download the index</a>", None),
    ("<a href=u/>Download the index</a>", None),
    ("Download the index", None), ("", None), (None, None), ("<", None), ("<a", None), ("<!-- <a href=u>Download the index</a>", None),
    ("<a href=u><a>" * 300 + "Download the index", "u"),
    ("<p>" * 200 + "<a href=u>Download the index</a>", "u"),
]


def test_anchor_cases(spark):
    df = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(CASES)], "i int, html string")
    got = {r.i: r.href for r in df.select("i", first_link_with_text("html", TEXT).alias("href")).collect()}
    assert [(h, got[i]) for i, (h, _) in enumerate(CASES)] == [(h, u) for h, u in CASES]


def test_long_odd_pages_end_in_time(spark):
    pages = ["<a " * 20_000 + TEXT, "<!--" * 20_000 + TEXT, "<script " * 20_000 + TEXT, "<a href='" * 3_000 + TEXT, "x<y " * 20_000 + TEXT]
    df = spark.createDataFrame([(p,) for p in pages], "html string")
    assert [r[0] for r in df.select(first_link_with_text("html", TEXT)).collect()] == [None] * 5


@pytest.mark.parametrize("text, want", [
    ("a&amp;lt;b", "a&lt;b"), ("&#128512;&#x1F600;", "😀😀"), ("&unknown; & &;", "&unknown; & &;"), ("&lt&gt;", "<>"),
    ("&#0;&#xD800;&#9999999;", "�" * 3), ("plain", "plain"), ("", ""), ("&nbsp;", " ")])
def test_references(spark, text, want):
    assert spark.createDataFrame([(text,)], "t string").select(unescape(_col("t"))).first()[0] == want


def _col(name):
    from pyspark.sql import functions as F

    return F.col(name)
