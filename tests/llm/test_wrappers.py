"""What the wrappers of pages keep and drop: recurring headings, near copies, names and forms inside articles."""

from lingualake.llm import pages


def _texts(spark, rows):
    df = spark.createDataFrame([(i, "https://a.example/%d" % i, h) for i, h in enumerate(rows)], "page_id long, url string, html string")
    return [r["text"] for r in pages.extract_pages(df).orderBy("page_id").collect()]


def _kept(page):
    return [t for _, aside, t in pages.parse(page) if not aside]


def test_recurring_headings_stay_and_nameless_templates_go(spark):
    page = "<body><div><p>Home</p><p>Shop</p></div><div><h1>T{0}</h1><h2>Introduction</h2><p>first {0}</p><div>Subscribe now</div><p>As before.</p><p>second {0}</p><section><h2>Conclusion</h2><p>last {0}</p></section></div><div><p>Imprint</p></div></body>"
    want = "T{0}\n\nIntroduction\n\nfirst {0}\n\nAs before.\n\nsecond {0}\n\nConclusion\n\nlast {0}"
    assert _texts(spark, [page.format(i) for i in range(20)]) == [want.format(i) for i in range(20)]


def test_two_near_copies_keep_what_they_share(spark):
    page = "<body><article><h1>Same head</h1><p>the same paragraph</p><p>ends in {0}</p></article></body>"
    assert _texts(spark, [page.format(i) for i in range(2)]) == [f"Same head\n\nthe same paragraph\n\nends in {i}" for i in range(2)]


def test_names_and_forms_inside_an_article():
    assert _kept("<main><h1>T</h1><section class='related-work'><p>earlier studies</p></section><p class=notice>mind the gap</p></main>") == ["T", "earlier studies", "mind the gap"]
    assert _kept("<article><p>text</p><div class='comment-list'><p>bad</p></div><div class=ad>buy</div><ul class='social share'><li>x</li></ul></article>") == ["text"]
    assert _kept("<body><div id=main><header><h1>Head</h1></header><p>text</p></div></body>") == ["Head", "text"]
    assert _kept("<body><header><h1>Site</h1></header><div class='related-work'>x</div><p>text</p></body>") == ["text"]
    assert _kept("<article><p>a long text of the article</p><form><p>Your mail</p></form></article>") == ["a long text of the article"]
    assert _kept("<form><main><p>in a form</p></main></form><p>some text that is longer than the form</p>") == ["in a form", "some text that is longer than the form"]
    assert _kept("") == [] and pages.in_slots([], [], []) == []
