from canopy.llm import htmltext as H


def text(page, known=()):
    root, mains = H.study(page)
    H.hash_outside(root)
    return H.blocks(root, mains, frozenset(known))


def test_blocks_entities_and_white_space():
    assert text("<article><h1>T &amp; U</h1><p>a\n b<br>c&nbsp;d<p><b>e</b>f</article>") == "T & U\n\na b c d\n\nef"
    assert text("<p>x<ul><li>1<li>2</ul><table><tr><td>3<td>4</table>y") == "x\n\n1\n\n2\n\n3\n\n4\n\ny"
    assert text("1 < 2 <p>a<b>c &lt;i&gt;</p>") == "1 < 2\n\nac <i>"


def test_boilerplate_goes():
    page = ('<html><head><title>t</title><script>var t="</p>";</script><style>p{}</style></head><body class="has-sidebar">'
            '<header><h1>Site</h1></header><nav><ul><li><a href="x">m</a></li></ul></nav><!-- <p>c</p> -->'
            '<div class="ad">buy</div><div id="cookie-notice">ok?</div><article><header><h1>Head</h1></header><p>Body'
            '<p>More<form><input value=1>f</form><div class="comments"><p>reader</p></div><aside>s</aside></article>'
            '<div class="sidebar-left">s</div><footer>f</footer></body></html>')
    assert text(page) == "Head\n\nBody\n\nMore"


def test_odd_markup():
    assert text("") == "" and text("<") == "<" and text("<p") == ""
    assert text("<article><p>a</span></div>b") == "ab"
    assert text('<p title="a>b">c</p><p title="unclosed>d</p>') == "c\n\nd"
    assert text("<article><div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert text("<p>a<!-- never closed <p>b") == "a"
    assert text("<script>if (a<b) { '</p>' }") == ""


def pages():
    rows = []
    for i in range(60):
        body = f"<div><p>Story number {i} tells {i * 7} things.</p><p>And the end of {i}.</p></div>"
        rows.append((i, f"https://a.example/{i}", f"<body><div><span>Our site</span><i>since {1990 + i % 2}</i></div>{body}"
                     "<div><div>Partner links</div><p>All rights</p></div></body>"))
    rows.append((100, "https://b.example/1", "<body><div><div>Partner links</div><p>All rights</p></div><p>Own</p></body>"))
    rows += [(200 + i, "https://c.example/x", "<article><p>Copied story.</p></article>") for i in range(30)]
    return rows + [(300, None, None), (301, "", ""), (302, "no host", "<p>lone</p>"), (302, "no host", "<p>lone</p>")]


def test_templates_recur_on_their_host_only(spark):
    df = spark.createDataFrame(pages(), "page_id long, url string, html string").selectExpr("*", "1 AS host", "2 AS hash")
    out = {r.page_id: r for r in H.extract(df).collect()}
    assert out[5].text == "Story number 5 tells 35 things.\n\nAnd the end of 5."
    assert out[100].text == "Partner links\n\nAll rights\n\nOwn"
    assert out[210].text == "Copied story." and out[300].text == "" and out[302].text == "lone"
    assert all(r.n_chars == len(r.text) for r in out.values())
    assert H.extract(df).count() == len(pages())
    assert H.extract(df.where("false")).count() == 0


def test_template_table_is_bounded_and_counts_pages(spark):
    df = spark.createDataFrame([(h, p) for _, u, p in pages() for h in [u or ""]], "host string, html string")
    df = df.selectExpr("regexp_extract(host, '//([^/]*)', 1) AS host", "html")
    got = {r.host: len(r.hashes) for r in H.templates(df).collect()}
    assert got["a.example"] >= 4 and "b.example" not in got


def test_text_beside_a_marked_element_stays():
    assert text("<main><div>story</div><article class='card'>teaser</article></main>") == "story\n\nteaser"
    assert text("<body><h1>Head</h1><div>one</div><div>two</div><article>small</article></body>") \
        == "Head\n\none\n\ntwo\n\nsmall"
    assert text("<div role=main><header>lead</header><article>a</article></div><footer>f</footer><div class=ad>x</div>") \
        == "lead\n\na"
    assert text("<article>a<main>b</main></article><article>c</article>") == "a\n\nb\n\nc"


def test_text_outside_the_article_goes_only_if_it_recurs(spark):
    rows = [(i, "https://a.example/x", f"<body><div>Our site</div><div>Lead {i}</div><article><p>Story {i}</p></article>"
             "<p>All rights</p></body>") for i in range(20)]
    out = H.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert {r.page_id: r.text for r in out} == {i: f"Lead {i}\n\nStory {i}" for i in range(20)}


def test_boxes_that_recur_inside_the_article_go(spark):
    box = "<div><p>Read our app</p><ul><li>now</li></ul></div>"
    rows = [(i, "https://a.example/x", f"<article><h2>Background</h2><p>Story {i} has its own words and an end.</p>{box}"
             f"<p>More of {i}, which goes on for a while.</p></article>") for i in range(20)]
    copied = "<div><p>Copied story of many words.</p><section><p>Its second part.</p></section></div>"
    rows += [(100 + i, "https://b.example/x", f"<article><p>Seen {i}</p>{copied}</article>") for i in range(20)]
    rows += [(200 + i, "https://c.example/x", f"<article>{box}<p>The same story with the same words.</p></article>"
              f"<p>{i}</p>") for i in range(20)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    out = {r.page_id: r.text for r in H.extract(df).collect()}
    for i in range(20):
        assert out[i] == f"Background\n\nStory {i} has its own words and an end.\n\nMore of {i}, which goes on for a while."
        assert out[100 + i] == f"Seen {i}\n\nCopied story of many words.\n\nIts second part."
        assert out[200 + i] == f"Read our app\n\nnow\n\nThe same story with the same words.\n\n{i}"
