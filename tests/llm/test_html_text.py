from html.parser import HTMLParser

from filmlens.llm import html_text


class Article(HTMLParser):
    """Text of the first article, for the plain layout of the test pages."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.now = False, [], ""

    def flush(self):
        text = " ".join(self.now.split())
        self.now = ""
        if text:
            self.blocks.append(text)

    def handle_starttag(self, tag, attrs):
        if tag == "article":
            self.inside = True
        if tag not in ("b", "a"):
            if tag == "br":
                self.now += " "
            else:
                self.flush()

    def handle_endtag(self, tag):
        if tag not in ("b", "a"):
            self.flush()
        if tag == "article":
            self.inside = False

    def handle_data(self, data):
        if self.inside:
            self.now += data


def brute(source):
    reader = Article()
    reader.feed(source or "")
    reader.close()
    reader.flush()
    return "\n".join(reader.blocks)


def test_query_against_another_parser(spark):
    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
        got = html_text.query(spark, folder).collect()
        assert len(got) == len(pages)
        for r in got:
            assert (r.url, r.text, r.n_chars) == (pages[r.page_id].url, brute(pages[r.page_id].html), len(r.text))


def text_of(source):
    return html_text.main_text(html_text.parse(source), set())


def test_markup():
    assert text_of("") == "" and text_of("plain &lt;b&gt; text") == "plain <b> text"
    page = """<body class="has-sidebar"><header>Site</header><nav><p>Menu<ul><li>a<li>b</ul></nav><div id=cookie-notice>We use <b>cookies</b><div>more</div></div>
      <main><article class='post'><header><h1>Title &amp;&nbsp; more</h1></header><p>One <i>two</i>three<p>four<br>five<script>if (a < b) document.write("</p>")</script>
      <aside>Side</aside><ul><li>x<li>y</ul><table><tr><td>1<td>2</table><form><input><button>Go</button></form>
      <section class="comments"><article>Reader says</article></section><footer>Foot</footer><p>last &am &copy 1 < 2</article></main><footer>End</footer>"""
    assert text_of(page) == "Title & more\nOne twothree\nfour five\nx\ny\n1\n2\nlast &am © 1 < 2"
    assert text_of("<article>a<!-- <p>no --> b<style>p{}</style></article> after") == "a b"
    assert text_of("<div class=ad>no</div><p>yes<p hidden>no<p>cut <a href='x") == "yes\ncut"
    assert text_of("<div class='page with-sidebar'><p title='a hidden gem'>kept</div><div class=sidebar>no</div>") == "kept"
    assert text_of("<div class='widget'>no<main>yes<div class='social share'>no</div></main></div>") == "yes"
    assert text_of("<div class='menu'>all there is</div>") == "all there is" and text_of("<nav>only a menu</nav>") == ""
    assert text_of("<article>" + "<div>x" * 5000 + "<p" + " a" * 5000) == "\n".join("x" * 5000)


def test_references_do_not_reach_over_tags():
    page = html_text.parse("<p>A &am<b>p;</b> B &amp;<!-- x -->lt; C&nbsp;<i>&eacute;</i></p>")
    assert page.texts == ["A &amp; B &lt; C é"]


def test_host_repeats(spark):
    head, foot = "<p>Welcome to the site that has all of it for you today</p>", "<div>Home</div><div>About</div><div>All rights reserved by the owners of this very site</div>"
    pages = [(i, f"http://a.org/{i}", f"{head}<p>unique text number {i} of the host</p>{foot}", "x", 1) for i in range(4)]
    pages += [(10, "http://b.org/1", head, "x", 1), (10, "http://b.org/1", head, "x", 1), (11, None, None, "x", 1), (None, "", "", "x", 1), (12, "http://c.org/", f"{head}{foot}", "x", 1)]
    several = "<article>Welcome to the site that has all of it for you today</article><article>the {} story</article>"
    pages += [(20 + i, f"http://a.org/s{i}", several.format(i), "x", 1) for i in range(2)]
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string, text string, covered int")
    got = [(r.page_id, r.text) for r in html_text.extract(df).collect()]
    words = "Welcome to the site that has all of it for you today"
    assert sorted(got, key=repr) == sorted(
        [(i, f"unique text number {i} of the host") for i in range(4)] + [(10, words), (10, words), (11, ""), (None, ""), (20, "the 0 story"), (21, "the 1 story")]
        + [(12, words + "\nHome\nAbout\nAll rights reserved by the owners of this very site")],
        key=repr,
    )
    assert html_text.extract(df.limit(0)).collect() == []


def test_repeats_inside_one_of_several_candidates(spark):
    notice = "<p>Please do support the work of our small team with a gift today</p>"
    page = "<article>Teaser of another page</article><article><p>the {0} story is told here in so many words as it takes, {0} times</p>" + notice + "</article>"
    copied = "<article>Short one</article><article>" + notice + "</article>"
    pages = [(i, f"http://a.org/{i}", page.format(i)) for i in range(3)] + [(9, "http://a.org/9", copied)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    assert [got[i] for i in range(3)] == [f"the {i} story is told here in so many words as it takes, {i} times" for i in range(3)]
    assert got[9] == "Short one"


def test_template_of_the_host_inside_the_only_candidate(spark):
    notice, common = "<p>Please do support the work of our small team with a gift today</p>", "<p>it is a saying that two of the stories have alike</p>"
    page = "<nav><a>Menu</a></nav><article><h2>Summary</h2><p>the {0} story is told here in so many words as it takes, {0} times</p>{1}<p>The end</p></article>"
    pages = [(i, f"http://a.org/{i}", page.format(i, common * (i < 2) + notice)) for i in range(6)]
    # A host of few pages, and one that copies the notice alone.
    pages += [(10 + i, f"http://b.org/{i}", page.format(i, notice)) for i in range(3)] + [(20, "http://a.org/20", f"<article>{notice}</article>")]
    # Short blocks of a page without any candidate.
    pages += [(30 + i, f"http://c.org/{i}", f"<div>Home</div><div>About</div><div>the {i} story is told here in so many words as it takes</div><div>Imprint</div>") for i in range(5)]
    got = {r.page_id: r.text for r in html_text.extract(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    story, words = "Summary\nthe {0} story is told here in so many words as it takes, {0} times", "Please do support the work of our small team with a gift today"
    for i in range(6):
        assert got[i] == story.format(i) + "\nit is a saying that two of the stories have alike" * (i < 2) + "\nThe end"
    assert [got[10 + i] for i in range(3)] == [f"{story.format(i)}\n{words}\nThe end" for i in range(3)]
    assert got[20] == words
    assert [got[30 + i] for i in range(5)] == [f"the {i} story is told here in so many words as it takes" for i in range(5)]
