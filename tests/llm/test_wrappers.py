from cases import prose

from zonetally.llm import wrappers as wr


def page(k, article, host="a.example.com", extra=""):
    return f"""<!DOCTYPE html><html><head><title>T{k}</title><style>p{{}}</style><script>if (a<b) "</p>"</script></head><body>
<header class="site"><a href="/">Home of {host}</a></header><nav><ul><li><a href="/a">A{k}</a><li><a href="/b">B</a></ul></nav>
<div id="cookie-notice">We use cookies {k}</div><div class="content-area"><article>{article}<p class="licence">All rights are with the makers.</p></article>
<aside>See also {k}</aside></div>{extra}<section id="comments"><p>reader {k} says</p></section><form><p>Your mail</p></form><footer>&copy; {k}</footer></body></html>"""


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, wrapper string")


def test_articles_without_chrome(spark):
    rows, want = [], {}
    for k in range(12):
        paragraphs = [prose(100 * k + j, 12) for j in range(k % 4 + 1)]
        article = f"<h1>Head &amp; {k}</h1>" + "".join(f"<p>{p}\n  <b>bold</b><br>end" for p in paragraphs)
        rows.append((k, f"https://a.example.com/{k}", page(k, article)))
        want[k] = "\n".join([f"Head & {k}", *(f"{p} bold end" for p in paragraphs)])
    got = {r.page_id: r.text for r in wr.main_texts(pages(spark, rows)).collect()}
    assert got == want  # the licence line, the same on all pages, is template


def test_awkward_pages(spark):
    one = page(1, "<p>Only page of its host.</p>")
    rows = [(1, "http://b.example.com", one), (2, None, None), (3, "", ""), (None, "http://c.example.com", "<p>a<p>b &lt; c"), (4, "http://c.example.com", "<p>a<p>b &lt; c"),
            (5, "x", "<!-- open"), (6, "x", "a < b <b>c</b> &#233;"), (7, "x", "<div " * 2000), (8, "http://b.example.com", "<article>" + "<p>word " * 20000)]
    got = [(r.page_id, r.text) for r in wr.main_texts(pages(spark, rows)).collect()]
    by = dict(got)
    assert len(got) == len(rows)
    assert by[1] == "Only page of its host.\nAll rights are with the makers."  # one page shows no template
    assert by[2] == by[3] == by[5] == "" and by[4] == by[None] == "a\nb < c" and by[6] == "a < b c é"
    assert by[8].count("word") == 20000 and by[8].count("\n") == 19999
    assert wr.main_texts(pages(spark, [])).count() == 0


def test_copies_do_not_become_template(spark):
    article = "".join(f"<p>{prose(j, 15)}</p>" for j in range(5))
    rows = [(k, "http://a.example.com/x", page(k, article)) for k in range(20)]
    got = {r.text for r in wr.main_texts(pages(spark, rows)).collect()}
    assert all(prose(j, 15) in text for text in got for j in range(5))


def plain(title, main, kind="div", end=""):
    return f"<html><head><title>{title}</title></head><body><{kind}>{main}</{kind}>{end}</body></html>"


def test_constants_of_pages_with_one_title_or_none(spark):
    notice = "Reprinted by kind leave of the makers of this site."
    rows = [(k, "http://a.example.com/", plain("Site", f"<p>{prose(k, 20)}</p><p>{notice}</p>")) for k in range(10)]
    rows += [(100 + k, "http://b.example.com/", f"<body><div><p>{prose(100 + k, 20)}</p><p>{notice}</p></div></body>") for k in range(10)]
    rows += [(200 + k, "http://c.example.com/", plain(f"T{k % 3}", f"<p>{prose(200 + k, 20)}</p><p>{notice}</p>")) for k in range(3)]
    got = {r.page_id: r.text for r in wr.main_texts(pages(spark, rows)).collect()}
    assert got == {k: prose(k, 20) for k, _, _ in rows}


def test_constants_of_a_layout(spark):
    rows = [(k, "http://a.example.com/", plain(f"T{k}", f"<p>{prose(k, 20)}</p>" + "<p>Kept in the archive of the paper.</p>" * (k % 10 < 3), "section" if k % 10 < 3 else "div"))
            for k in range(100)]
    got = {r.page_id: r.text for r in wr.main_texts(pages(spark, rows)).collect()}
    assert got == {k: prose(k, 20) for k in range(100)}


def test_short_articles_under_long_constants(spark):
    menu = "<nav>" + "".join(f"<ul><li><a href='/{j}'>{prose(900 + j, 6)}</a></li></ul>" for j in range(20)) + "</nav>"
    boilerplate = "".join(f"<p>{prose(950 + j, 30)}</p>" for j in range(3))
    for_menu = [(k, "http://a.example.com/", f"<title>T{k}</title><body>{menu}<div><p>{prose(k, 6)}</p><p>Printed with leave.</p></div></body>") for k in range(9)]
    for_text = [(50 + k, "http://b.example.com/", plain(f"T{k}", f"<p>{prose(50 + k, 6)}</p>{boilerplate}")) for k in range(9)]
    got = {r.page_id: r.text for r in wr.main_texts(pages(spark, for_menu + for_text)).collect()}
    assert got == {k: prose(k, 6) for k, _, _ in for_menu + for_text}


def test_revisions_do_not_become_template(spark):
    article = "".join(f"<p>{prose(j, 15)}</p>" for j in range(5))
    rows = [(k, "http://a.example.com/x", plain(f"T{k}", f"{article}<p>{prose(50, 15)} rev{'abcdef'[k]} {prose(51, 15)}</p>")) for k in range(6)]
    rows += [(9, "http://b.example.com/x", plain("T", f"{article}<p>Seen {k} times</p>")) for k in range(6)]
    got = {r.text for r in wr.main_texts(pages(spark, rows)).collect()}
    assert all(prose(j, 15) in text for text in got for j in range(5))


def test_matching_keeps_order():
    one, _ = wr.parse("<div><h1>a</h1><p>b</p><ul><li>c</li></ul></div>")
    two, _ = wr.parse("<div><p>b</p><h1>a</h1><ul><li>c</li></ul></div>")
    n, pairs = wr.matching(one, two)
    assert n == 5  # root, div, ul, li and either h1 or p
    assert {x.name for x, y in pairs if x.name == y.name} >= {"div", "ul", "li"}


def test_broadcast_and_shuffle_agree(spark, monkeypatch):
    rows = [(k, f"http://h{k % 3}.example.com/", page(k, f"<p>{prose(k, 20)}</p>", f"h{k % 3}")) for k in range(15)]
    one = sorted((r.page_id, r.text) for r in wr.main_texts(pages(spark, rows)).collect())
    monkeypatch.setattr(wr, "MOST_ROWS", 0)
    monkeypatch.setattr(wr, "MOST_CHARACTERS", 0)
    assert one == sorted((r.page_id, r.text) for r in wr.main_texts(pages(spark, rows)).collect())
