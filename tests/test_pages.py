import timeit

from pyspark.sql import functions as F

from newslens.functions import urls as U
from newslens.functions.html_nodes import flatten
from newslens.operators import pages as P

KEEP = ["page_id", "url", "title"]
URL = "http://news.example.com/x/page.html"


def parsed(spark, *htmls):
    df = spark.createDataFrame([(i, URL, 'T/1: "x"', h) for i, h in enumerate(htmls)],
                               "page_id int, url string, title string, html string")
    return P.parse_pages(df, KEEP)


def article(spark, html, nested=False):
    r = P.articles(parsed(spark, html), KEEP, nested).first()
    return r.container_kind, list(r.paragraphs)


def test_flatten_intervals():
    nodes = flatten("<!doctype html><div id=a>x<p>y<br>z</div><!-- c -->w &amp; <b>v</b>")
    assert [(n["tag"], n["last"]) for n in nodes] == [
        ("div", 5), ("#text", 1), ("p", 5), ("#text", 3), ("br", 4), ("#text", 5), ("#text", 6), ("b", 8), ("#text", 8)]
    assert nodes[0]["id"] == "a" and nodes[6]["text"] == "w & "


def test_flatten_odd_markup():
    texts = lambda h: "".join(n["text"] for n in flatten(h) if n["tag"] == "#text")
    assert texts("a < b and c") == "a < b and c"
    assert texts('<a title="x>y">k</a>') == "k"
    assert texts("<script>if (a < b) '</p>';</script>t") == "t"
    assert texts("</p>t</b>") == "t"
    assert texts("<p") == "<p" and flatten("") == []
    assert texts('<a href="unclosed>text') == '<a href="unclosed>text'


def test_flatten_keeps_incomplete_tags_as_text():
    texts = [n["text"] for n in flatten('a <b "open <i>x</i> <!never <p')]
    assert texts == ['a <b "open ', None, "x", " <!never <p"]


def test_flatten_work_grows_with_the_page():
    for unit in ("<p><b>x</b>", '<a "', "<a ", "<a", "<!x ", "< x", "<a b='\">", "<a '\" "):
        took = []
        for n in (5_000, 40_000):
            best = min(timeit.repeat(lambda: flatten(unit * n), number=1, repeat=2))
            took.append(max(best, 0.002))
        assert took[1] < 24 * took[0], unit  # 8 times the page; all pairs would be 64 times the work


def test_container_order_is_by_selector(spark):
    html = '<div class="content"><p>in content</p></div><article><p>in article</p></article>'
    assert article(spark, html) == ("article", ["in article"])
    # the first article is empty, so the next selector wins although a later article has text
    html = '<article> </article><div class="big content"><p>c</p></div><article><p>late</p></article>'
    assert article(spark, html) == (".content", ["c"])
    assert article(spark, '<div id="main"><p>m</p></div><div class="story"><p>s</p></div>') == (".story", ["s"])
    assert article(spark, '<div class="storyteller"><p>no</p></div><div id="content"><p>yes</p></div>') == ("#content", ["yes"])


def test_longest_div_and_page_fallback(spark):
    assert article(spark, "<div><p>short</p></div><div><h2>much longer text</h2></div>") == ("longest div", ["much longer text"])
    long, short = "x" * 31, "y" * 30
    assert article(spark, f"<body><p>{short}</p><p>{long}</p><h1>{long}</h1></body>") == ("page", [long])


def test_boilerplate_is_removed_inside_only(spark):
    html = ("<article><nav><p>menu</p></nav><p>text<script>var p='<p>no</p>'</script></p>"
            "<aside><p>side</p></aside><h3> Head </h3><style>p{}</style></article>")
    assert article(spark, html) == ("article", ["text", "Head"])
    assert article(spark, "<aside><article><p>kept</p></article></aside>") == ("article", ["kept"])


def test_unclosed_paragraphs(spark):
    html = "<article><p><b>A<br><p>B</p><p>C</p></article>"
    assert article(spark, html) == ("article", ["A", "B", "C"])
    assert article(spark, html, nested=True) == ("article", ["ABC", "B", "C"])


def images(spark, inner):
    rows = P.images(parsed(spark, f"<article><p>t</p>{inner}</article>"), KEEP).orderBy("pos").collect()
    return [(r.pos, r.is_background, r.image_url, r.width, r.height, r.verdict) for r in rows]


def test_image_sizes_and_verdicts(spark):
    base = "http://news.example.com"
    got = images(spark, '<img src="/a.jpg" width="300" height="200px"><img src="b.png" width="299.9" height="400">'
                 '<img src="c.gif" style="width: 640px; height:480"><img src="d.jpg" width="50%" height="9">'
                 '<img src="/icons/e.jpg" width="900" height="900"><img src="/upload/f.jpg" width="900" height="900">'
                 '<img width="900" height="900"><img src="http://o.example.com/banner.jpg" width="900" height="900">')
    assert got == [
        (1, False, f"{base}/a.jpg", 300, 200, "keep"), (2, False, f"{base}/x/b.png", 299, 400, "small"),
        (3, False, f"{base}/x/c.gif", 640, 480, "keep"), (4, False, f"{base}/x/d.jpg", 0, 0, "size_unknown"),
        (5, False, f"{base}/icons/e.jpg", 900, 900, "icon"), (6, False, f"{base}/upload/f.jpg", 900, 900, "ad"),
        (8, False, "http://o.example.com/banner.jpg", 900, 900, "keep")]


def test_lazy_images_repeat_and_backgrounds_follow(spark):
    got = images(spark, '<img data-lazy-src="l.jpg" data-src="s.jpg" width="400" height="300">'
                 '<div data-original-src="o.jpg" style="background: url(&quot;/bg/x.jpg&quot;)"></div>'
                 "<i style=\"background-image:url('/logo.png')\"></i><i style='color:red'></i>")
    assert [(g[0], g[1], g[2].rsplit("/", 1)[1], g[5]) for g in got] == [
        (1, False, "s.jpg", "keep"), (2, False, "o.jpg", "size_unknown"), (3, False, "s.jpg", "keep"),
        (4, True, "x.jpg", "size_unknown")]


def test_videos(spark):
    html = ('<article><p>t</p><video src="own.mp4"><source src="a.webm"><source src="b.ogg"></video>'
            '<iframe src="https://www.youtube.com/embed/1"></iframe><iframe src="https://ads.example.com/"></iframe>'
            '<div class="Media-Box" data-src="clip.mp4" data-video="x.avi"></div>'
            '<script>videoUrl: "hidden.mp4"</script></article>')
    got = P.videos(parsed(spark, html), KEEP).orderBy("pos").collect()
    assert [(r.pos, r.video_url.rsplit("/", 1)[1], r.kind, r.file_name) for r in got] == [
        (1, "a.webm", "file", "T1 x_1.webm"), (2, "b.ogg", "file", "T1 x_2.ogg"), (3, "own.mp4", "file", "T1 x_3.mp4"),
        (4, "1", "link", "T1 x_4_link.txt"), (5, "clip.mp4", "file", "T1 x_5.mp4")]


def test_scripts_count_on_the_page_fallback_only(spark):
    html = "<body><p>short</p><script>var sourceURL = 'http://v.example.com/m.webm';</script></body>"
    assert [r.video_url for r in P.videos(parsed(spark, html), KEEP).collect()] == ["http://v.example.com/m.webm"]


def test_null_and_empty_pages(spark):
    df = spark.createDataFrame([(1, URL, "t", None), (2, URL, "t", "")], "page_id int, url string, title string, html string")
    pages = P.parse_pages(df, KEEP)
    assert P.images(pages, KEEP).count() == 0 and P.videos(pages, KEEP).count() == 0
    assert P.articles(pages, KEEP).where("container_kind = 'page'").count() >= 1


def test_extensions_and_names(one):
    assert one(U.image_extension, v="image/jpeg") == "jpg" and one(U.image_extension, v="image/webp") == "webp"
    assert one(U.image_extension, v=None) == "jpg" and one(U.image_extension, v="text/html") == "jpg"
    assert one(lambda v: U.video_extension(F.lit("video/webm"), v), v="a.mp4") == "webm"
    assert one(lambda v: U.video_extension(F.lit(""), v), v="a.ogg?x") == "ogg"
    assert one(lambda v: U.video_extension(F.lit(None).cast("string"), v), v="a.bin") == "mp4"
    assert one(lambda v: U.image_name(v, F.lit(3), F.lit("png")), v="a/b") == "ab_3.png"


PAGE = ('<title>T</title><article><img src="a.jpg" width=400 height=300><img src="/logo.png" width=400 height=300>'
        '<p>One &amp; only</p><iframe src="https://player.x/e?i=1"></iframe><video src="v.mp4"></video><p>Two</p></article>')


def pages_frame(spark, *titles):
    return spark.createDataFrame([(i, URL + str(i), t, PAGE) for i, t in enumerate(titles)],
                                 "position long, url string, title string, html string")


def test_records_hold_what_the_single_operators_give(spark):
    pages = pages_frame(spark, "A/B", "C").withColumnRenamed("position", "page_id")
    parsed_pages = P.parse_pages(pages, KEEP)
    records = P.page_records(pages, KEEP)
    for column, alone in (("images", P.images(parsed_pages, KEEP)), ("videos", P.videos(parsed_pages, KEEP))):
        assert sorted(map(tuple, P.one_each(records, KEEP, column).collect())) == sorted(map(tuple, alone.collect()))
    texts = {r.page_id: r.text for r in P.articles(parsed_pages, KEEP).collect()}
    assert {r.page_id: r.text for r in records.collect()} == texts
    plan = records._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_pages_are_stored_once_and_resumed(spark, tmp_path):
    import os
    import shutil

    from newslens.plans.page_jobs import SINKS, store_pages

    out = str(tmp_path / "out")
    tables = store_pages(spark, pages_frame(spark, "A", "B?", "A"), out)
    articles = {r.file_name: r for r in tables["articles"].collect()}
    assert set(articles) == {"A.txt", "B.txt"} and articles["A.txt"].position == 2  # the last one stays
    assert articles["B.txt"].value == (
        f"标题: B?\n网址: {URL}1\n\nOne & only\n\nTwo\n\n图片列表:\n1. B_1.jpg - 尺寸: 400x300\n"
        "\n\n视频列表:\n1. B_1.mp4\n2. B_2_link.txt\n")
    assert sorted((r.position, r.pos, r.file_name) for r in tables["images"].collect()) == [
        (0, 1, "A_1.jpg"), (1, 1, "B_1.jpg"), (2, 1, "A_1.jpg")]
    assert {r.value for r in tables["links"].collect()} == {"视频链接: https://player.x/e?i=1"}
    assert tables["processed"].count() == 3 and set(tables) == set(SINKS)
    # one sink is lost half-way: only it is written again, and no page is needed for it
    times = {name: os.path.getmtime(f"{out}/{name}/_SUCCESS") for name in ("records", *SINKS)}
    shutil.rmtree(f"{out}/videos")
    nothing = pages_frame(spark, "x").where("false")
    again = store_pages(spark, nothing, out)
    assert again["videos"].count() == 6 and again["articles"].count() == 2
    same = {name for name, t in times.items() if os.path.getmtime(f"{out}/{name}/_SUCCESS") == t}
    assert same == {"records", *SINKS} - {"videos"}
