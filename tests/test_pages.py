import pytest

from bookbase.functions import html as H
from bookbase.operators import extract as E

TABLE = '<table class="{}">{}</table>'


def rows(*pairs):
    return "".join(f"<tr><th>{a}</th><td>{b}</td></tr>" for a, b in pairs)


@pytest.fixture(scope="module")
def pages(spark):
    cases = {
        1: "<p>nothing</p>",
        2: TABLE.format("other", rows(("Title", "no"))) + TABLE.format("a bibrec b", rows(("Title", "yes"))),
        3: TABLE.format("bibrec", rows(("Title", "first"))) + TABLE.format("bibrec", rows(("Title", "second"))),
        4: "<table class='bibrec'><tr><th>Title</th></tr><tr><td>x</td></tr>" + rows(("Author", " <a>A</a>\n&eacute; ")),
        5: TABLE.format("bibrec", rows(("Subject", "s1"), ("Nope", "n"), ("Subject", "s2"), ("Title", "&lt;b&gt; &amp;lt; &#233;&#x1F600;"))),
        6: "<table id=x class=bibrec>" + rows(("Title", "bare")) + "</table>",
        7: TABLE.format("bibrec-x", rows(("Title", "no"))),
        8: TABLE.format("BIBREC", rows(("Title", "class names keep their case"))),
    }
    return spark.createDataFrame([(k, "u", v) for k, v in cases.items()], "page_id bigint, url string, html string")


def test_fields(pages):
    got = {r["page_id"]: r for r in E.page_fields(pages).collect()}
    assert sorted(got) == [2, 3, 4, 5, 6]
    assert [got[i]["Title"] for i in (2, 3, 4, 5, 6)] == ["yes", "first", "", "<b> &lt; é😀", "bare"]
    assert got[4]["Author"] == "A\né" and got[5]["Subject"] == "s2" and got[5]["Note"] == ""


def test_forms_agree(pages):
    tables = E.pick_table(pages)
    one = E.tables_to_record(tables).orderBy("page_id").collect()
    two = E.pairs_to_record(E.rows_to_pairs(tables)).orderBy("page_id").collect()
    assert one == two


def test_multi(pages):
    got = E.page_fields(pages, multi=True).filter("page_id = 5").first()
    assert got["Subject"] == ["s1", "s2"] and got["Language"] == []


def test_no_shuffle(pages):
    assert "Exchange" not in E.page_fields(pages)._jdf.queryExecution().executedPlan().toString()


def test_unescape(one):
    assert one(lambda c: H.unescape(c), "&#38;lt;b &#38;#x41; &amp;amp;", "&times;&deg;&Aacute;&NotEqualTilde;", "&#150;&#55296;&#0;&#x80;&#129;",
               "& &; &#; &#x; a&b &#9999999999;") == [
        "&lt;b &#x41; &amp;", "×°Á≂̸", "–\ufffd\ufffd€\x81", "& &; &#; &#x; a&b \ufffd",
    ]
    assert one(lambda c: H.unescape(c), "a &nope; &quot;x&#39;&amp;amp;", "plain") == ["a &nope; \"x'&amp;", "plain"]
