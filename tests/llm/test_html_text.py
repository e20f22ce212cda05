import time

import pytest

from sieveflow.llm.html_text import Tags, extract, main_text, parse

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize("html, text", [
    ("", ""),
    ("plain &amp; simple", "plain & simple"),
    ("<article><h1>A</h1><p>b <b>c</b>d\n\n e<p>f</article><footer>no</footer>", "A\nb cd e\nf"),
    ("<body><nav><ul><li><a href=x>m</a></ul></nav><p>t1<br>t2</p><aside>s</aside></body>", "t1 t2"),
    ("<p>x</p><script>var a='<p>no</p>';</script><style>p{}</style><!-- <p>no</p> --><p>y", "x\ny"),
    ("<div class='cookie-notice'>no</div><main><p>yes &eacute;&#x41;&nbsp;z</p></main><div>outside</div>", "yes éA z"),
    ("<article>text<div id=comments><p>reader</p></div></article><article class='comment'>no</article>", "text"),
    ("<div class='page with-sidebar'><article><p>in</p></article></div>", "in"),
    ("<header>site</header><article><header><h1>Title</h1></header><p>p</p><form>f</form></article>", "Title\np"),
    ("<p hidden>no<p style='display: none'>no<p aria-hidden=true>no<p>yes", "yes"),
    ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
    ("</p></div>stray <a title='>'>ok</a> 1 < 2", "stray ok 1 < 2"),
    ("<article><div class=ad>buy</div><p>ok</p><div role=navigation>n</div>", "ok"),
    ("<textarea><p>no</p></textarea><title>no</title><p>only", "only"),
])
def test_main_text(html, text):
    assert main_text(parse(html)) == text


def test_deep_and_broken():
    assert main_text(parse("<div>" * 5000 + "deep" + "</div>" * 10)) == "deep"
    assert main_text(parse('<a href="' + "x" * 10000)).startswith("<a") is True
    assert main_text(parse("<b" + "<" * 5000)) is not None


def test_template_of_a_site_goes(spark):
    banner = "<div><span>Follow us everywhere</span></div>"
    rows = [(i, f"http://U@Site.example:80/{i}", f"<body>{banner}<div><p>Text {i} of its own</p><p>Seen twice</p></div></body>") for i in range(20)]
    rows = [(i, u, h if i < 2 else h.replace("<p>Seen twice</p>", "")) for i, u, h in rows]
    # few pages, and many pages that are one: no template
    rows += [(100 + i, "http://small.example/", f"<p>Same</p><p>{i}</p>") for i in range(5)]
    rows += [(200 + i, "http://copies.example/", "<p>Copied article</p>") for i in range(40)]
    rows += [(300, None, None), (None, "no url", ""), (300, None, None), (301, "http://site.example/x", banner)]
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS host", "2 AS digests", "3 AS text", "4 AS n_chars")
    got = extract(df).collect()
    assert len(got) == len(rows)
    text = {r.page_id: r.text for r in got}
    assert text[0] == "Text 0 of its own\nSeen twice" and text[5] == "Text 5 of its own"
    assert text[101] == "Same\n1" and text[220] == "Copied article"
    assert text[300] == "" and text[None] == "" and text[301] == ""
    assert all(r.n_chars == len(r.text) for r in got)


def test_empty(spark):
    assert extract(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("piece", ['<a "', "<b ", "<", "<a ' ", '<a ">" ', "<b>", "</i>", "<!--", "<script>", "<p>x", "<a<a", "<![CDATA[", "<!x", 'x" ', "<td>"])
@pytest.mark.parametrize("end", ["", ">", "'", '">', "</i>" * 20_000])
def test_broken_pages_of_a_megabyte(piece, end):
    """Each kind of text that a tag can get lost in; once all were quadratic."""
    source = piece * ((1 << 20) // len(piece)) + end
    start = time.process_time()
    main_text(parse(source))
    assert time.process_time() - start < 8


def test_quotes():
    def tags(source):
        scanner, at, out = Tags(source), 0, []
        while (t := scanner.next(at)):
            at = t[1]
            out.append((t[2], t[3], t[4]))
        return out

    assert tags("""<a b="x>y" c='"'>z</a >""") == [("a", """ b="x>y" c='"'""", False), ("a", " ", True)]
    assert tags("""<a b="x>y</a>""") == [("a", ' b="x', False), ("a", "", True)]
    assert tags("a < b <!-- <i> --> <!doctype html><br/>1 <2 <") == [("", "", False), ("", "", False), ("br", "/", False)]
    assert tags("<p 'a>b") == [("p", " 'a", False)] and tags("<p") == [] and tags("<!-- <p>") == [("", "", False)]
