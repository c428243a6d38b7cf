"""Article text, images and videos of web pages.

A page is parsed once into its node array; text, image and video operators all
read that array with built-in array functions, inside the same stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from newslens import constants as K
from newslens.functions.html_nodes import NODES, flatten_batches
from newslens.functions.text import contains_any, let, strip
from newslens.functions.urls import (
    background_name, image_extension, image_name, is_video_link, resolve_url, video_extension,
    video_name,
)

PAGE_TITLE = r"(?is)<title[^>]*>(.*?)</title>"


def parse_pages(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """Pages with their chosen container and its live nodes.

    ``container_kind`` is a selector, ``longest div`` or ``page``. ``live`` has
    the container's descendants with boilerplate blanked out, at unchanged
    distances, so a subtree stays one slice.
    """
    schema = ", ".join([f"{f.name} {f.dataType.simpleString()}"
                        for f in pages.select(*keep).schema] + [f"nodes {NODES}"])
    nodes = pages.select(*keep, html).mapInArrow(flatten_batches(keep, html), schema)
    box = F.col("_box")
    return nodes.withColumn("_box", _container(F.col("nodes"))).select(
        *keep, box["kind"].alias("container_kind"), (box["kind"] == "page").alias("_loose"),
        _live(F.col("nodes"), box).alias("live"))


def _inside(nodes: Column, element: Column) -> Column:
    return F.slice(nodes, element["node"] + 2, element["last"] - element["node"])


def _selected(node: Column, selector: str) -> Column:
    if selector.startswith("#"):
        return node["id"] == selector[1:]
    if selector.startswith("."):
        return F.array_contains(F.split(node["class"], r"\s+"), selector[1:])
    return node["tag"] == selector


def _box(kind: str, node: Column, last: Column) -> Column:
    return F.struct(F.lit(kind).alias("kind"), node.alias("node"), last.alias("last"))


def _container(nodes: Column) -> Column:
    """First selector whose first element holds text; else the longest div; else the page."""
    def first_of_each(named: Column) -> Column:
        def first(selector: str) -> Column:
            hits = F.slice(F.filter(named, lambda n: _selected(n, selector)), 1, 1)
            return F.transform(hits, lambda n: _box(selector, n["node"], n["last"]))

        return F.concat(*[first(s) for s in K.CONTAINER_SELECTORS])

    named = F.filter(nodes, lambda n: n["id"].isNotNull() | n["class"].isNotNull() | (n["tag"] == "article"))
    by_selector = F.get(F.filter(let(named, first_of_each), lambda c: F.exists(
        _inside(nodes, c), lambda n: (n["tag"] == "#text") & (strip(n["text"]) != ""))), F.lit(0))

    def text_length(element: Column) -> Column:
        return F.aggregate(_inside(nodes, element), F.lit(0), lambda total, n: total + F.when(
            n["tag"] == "#text", F.length(strip(n["text"]))).otherwise(0))

    divs = F.transform(F.filter(nodes, lambda n: n["tag"] == "div"), lambda d: F.struct(
        text_length(d).alias("length"), (-d["node"]).alias("before"), d["last"].alias("last")))
    by_length = let(F.array_max(divs), lambda d: F.when(
        d.isNotNull(), _box("longest div", -d["before"], d["last"])))
    body = F.transform(F.slice(F.filter(nodes, lambda n: n["tag"] == "body"), 1, 1),
                       lambda n: _box("page", n["node"], n["last"]))
    whole = _box("page", F.lit(-1), F.size(nodes) - 1)
    return F.coalesce(by_selector, by_length, F.get(body, F.lit(0)), whole)


def _live(nodes: Column, box: Column) -> Column:
    """Container nodes; those in boilerplate below the container are tagged ``#dead``.

    On the whole-page fallback nothing is removed.
    """
    return let(box, lambda b: F.transform(_inside(nodes, b), lambda n: F.when(
        (b["kind"] != "page") & (n["shade"] > b["node"]), n.withField("tag", F.lit("#dead"))).otherwise(n)))


def _subtree(live: Column, element: Column, last: Column) -> Column:
    """Descendants of ``element`` up to node ``last``, as a slice of ``live``."""
    first_node = F.get(live, F.lit(0))["node"]
    return F.slice(live, element["node"] - first_node + 2, last - element["node"])


def _joined_text(nodes: Column) -> Column:
    return F.array_join(F.transform(F.filter(nodes, lambda n: n["tag"] == "#text"),
                                    lambda n: strip(n["text"])), "")


def paragraphs(live: Column, loose: Column, nested: bool = False) -> Column:
    """Texts of paragraphs and headings.

    Flat: a block ends where the next one starts, so an unclosed paragraph does
    not swallow its successors. Nested: it keeps its whole subtree, and inner
    text then occurs once per enclosing block.
    """
    def texts(live: Column) -> Column:
        blocks = F.filter(live, lambda n: n["tag"].isin(*K.BLOCK_TAGS))
        if nested:
            return F.transform(blocks, lambda b: F.struct(
                b["tag"].alias("tag"), _joined_text(_subtree(live, b, b["last"])).alias("text")))
        # each block next to its successor; the last one has none
        return let(blocks, lambda bs: F.zip_with(bs, F.slice(bs, 2, F.greatest(F.size(bs), F.lit(1))), lambda b, after: F.struct(
            b["tag"].alias("tag"), _joined_text(_subtree(live, b, F.least(
                b["last"], F.coalesce(after["node"] - 1, b["last"])))).alias("text"))))

    kept = F.filter(let(live, texts), lambda t: F.when(
        loose, (t["tag"] == "p") & (F.length(t["text"]) > K.LOOSE_PARAGRAPH_MIN)).otherwise(t["text"] != ""))
    return F.transform(kept, lambda t: t["text"])


def articles(parsed: DataFrame, keep: list[str], nested: bool = False) -> DataFrame:
    """Container kind, paragraphs and text of each page."""
    found = parsed.select(*keep, "container_kind", paragraphs(
        F.col("live"), F.col("_loose"), nested).alias("paragraphs"))
    return found.withColumn("text", F.array_join("paragraphs", "\n\n"))


def _attr(node: Column, name: str) -> Column:
    return F.nullif(node["attrs"][name], F.lit(""))


def image_candidates(live: Column) -> Column:
    """Image tags, then tags with lazy attributes, then background styles.

    A tag may occur twice; positions count every candidate.
    """
    def having(nodes: Column, name: str) -> Column:
        return F.filter(nodes, lambda n: (n["tag"] != "#dead") & n["attrs"][name].isNotNull())

    def gather(nodes: Column) -> Column:
        tags = F.concat(F.filter(nodes, lambda n: n["tag"] == "img"),
                        *[having(nodes, a) for a in K.LAZY_IMAGE_ATTRS])
        from_tags = F.transform(tags, lambda n: F.struct(
            F.lit(False).alias("is_background"),
            F.coalesce(*[_attr(n, a) for a in K.IMAGE_SOURCE_ATTRS]).alias("src"),
            _attr(n, "width").alias("width"), _attr(n, "height").alias("height"),
            _attr(n, "style").alias("style")))
        urls = F.transform(having(nodes, "style"), lambda n: F.regexp_extract(
            n["attrs"]["style"], K.BACKGROUND_PATTERN, 1))
        nothing = F.lit(None).cast("string")
        from_styles = F.transform(
            F.filter(urls, lambda u: (u != "") & ~contains_any(F.lower(u), K.BACKGROUND_MARKS)),
            lambda u: F.struct(F.lit(True).alias("is_background"), u.alias("src"), nothing.alias("width"),
                               nothing.alias("height"), nothing.alias("style")))
        return F.concat(from_tags, from_styles)

    return let(live, gather)


def _pixels(value: Column) -> Column:
    """Truncated number of an attribute such as ``300``, ``300px`` or ``299.6``."""
    plain = F.trim(F.replace(value, F.lit("px"), F.lit("")))
    number = F.when(plain.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$"), plain.try_cast("double"))
    return number.try_cast("int")


def display_size(width: Column, height: Column, style: Column) -> Column:
    """(width, height) from attributes, else from style, else (0, 0)."""
    w, h = _pixels(width), _pixels(height)
    sw, sh = [F.regexp_extract(style, rf"{side}\s*:\s*(\d+)", 1).try_cast("int") for side in ("width", "height")]

    def size(a: Column, b: Column) -> Column:
        return F.struct(a.alias("width"), b.alias("height"))

    return (F.when(w.isNotNull() & h.isNotNull(), size(w, h))
            .when(sw.isNotNull() & sh.isNotNull(), size(sw, sh))
            .otherwise(size(F.lit(0), F.lit(0))))


def image_entries(live: Column, url: Column, title: Column, content_type: Column | None = None) -> Column:
    """All image candidates of a page as an array, each with its verdict.

    ``verdict`` is ``keep``, ``icon``, ``ad``, ``small`` or ``size_unknown``;
    the last one marks images whose size only the file itself could tell.
    """
    extension = image_extension(F.lit(None).cast("string") if content_type is None else content_type)

    def sized(c: Column) -> Column:
        return F.struct(
            c["pos"].alias("pos"), c["is_background"].alias("is_background"), resolve_url(url, c["src"]).alias("image_url"),
            display_size(c["width"], c["height"], c["style"]).alias("size"))

    def judged(c: Column) -> Column:
        lower, width, height = F.lower(c["image_url"]), c["size"]["width"], c["size"]["height"]
        verdict = (
            F.when(c["is_background"], F.lit("size_unknown"))
            .when(contains_any(lower, K.ICON_MARKS), "icon")
            .when(contains_any(lower, K.AD_MARKS), "ad")
            .when((width == 0) | (height == 0), "size_unknown")
            .when((width < K.MIN_IMAGE_WIDTH) | (height < K.MIN_IMAGE_HEIGHT), "small")
            .otherwise("keep"))
        name = F.when(c["is_background"], background_name(title, c["pos"], extension)
                      ).otherwise(image_name(title, c["pos"], extension))
        return F.struct(
            c["pos"].alias("pos"), c["is_background"].alias("is_background"), c["image_url"].alias("image_url"),
            width.alias("width"), height.alias("height"), verdict.alias("verdict"), name.alias("file_name"))

    numbered = F.transform(image_candidates(live), lambda c, i: c.withField("pos", i + 1))
    found = F.filter(numbered, lambda c: c["src"].isNotNull())
    return F.transform(F.transform(found, sized), judged)


def images(parsed: DataFrame, keep: list[str], url: str = "url", title: str = "title",
           content_type: Column | None = None) -> DataFrame:
    """One row per image candidate with its verdict."""
    return one_each(parsed.select(*keep, image_entries(
        F.col("live"), F.col(url), F.col(title), content_type).alias("_all")), keep)


def one_each(entries: DataFrame, keep: list[str], column: str = "_all") -> DataFrame:
    # the outer form, since the plain one would evaluate the list again as a filter
    return entries.select(*keep, F.explode_outer(column).alias("_one")).where("_one IS NOT NULL").select(*keep, "_one.*")


def video_candidates(live: Column) -> Column:
    """Video sources in order: video tags, players in frames, data attributes, scripts."""
    return let(live, _video_sources)


def _video_sources(live: Column) -> Column:
    def own(n: Column) -> Column:
        inner = F.filter(_subtree(live, n, n["last"]), lambda s: s["tag"] == "source")
        return F.concat(F.transform(inner, lambda s: _attr(s, "src")), F.array(_attr(n, "src")))

    tagged = F.flatten(F.transform(F.filter(live, lambda n: n["tag"] == "video"), own))
    frames = F.filter(
        F.transform(F.filter(live, lambda n: n["tag"] == "iframe"), lambda n: _attr(n, "src")),
        lambda s: s.isNotNull() & contains_any(s, K.VIDEO_FRAME_MARKS))
    players = F.filter(live, lambda n: (n["tag"] != "#dead") & n["class"].isNotNull()
                       & contains_any(F.lower(n["class"]), K.VIDEO_CLASS_MARKS))
    data = F.filter(
        F.flatten(F.transform(players, lambda n: F.array(*[_attr(n, a) for a in K.VIDEO_DATA_ATTRS]))),
        lambda s: s.isNotNull() & contains_any(s, K.VIDEO_DATA_FORMATS))
    scripts = F.flatten(F.transform(
        F.filter(live, lambda n: n["tag"] == "script"),
        lambda n: F.regexp_extract_all(F.coalesce(n["text"], F.lit("")), F.lit(K.VIDEO_SCRIPT_PATTERN), F.lit(1))))
    return F.array_compact(F.concat(tagged, frames, data, scripts))


def video_entries(live: Column, url: Column, title: Column, content_type: Column | None = None) -> Column:
    """All video sources of a page as an array: absolute URL, link or file, name."""
    content_type = F.lit(None).cast("string") if content_type is None else content_type
    full = F.transform(_numbered(video_candidates(live)), lambda v: F.struct(
        v["pos"].alias("pos"), resolve_url(url, v["src"]).alias("video_url")))
    return F.transform(full, lambda v: F.struct(
        v["pos"].alias("pos"), v["video_url"].alias("video_url"),
        F.when(is_video_link(v["video_url"]), "link").otherwise("file").alias("kind"),
        video_name(title, v["pos"], v["video_url"], video_extension(content_type, v["video_url"])).alias("file_name")))


def _numbered(sources: Column) -> Column:
    return F.transform(sources, lambda s, i: F.struct((i + 1).alias("pos"), s.alias("src")))


def videos(parsed: DataFrame, keep: list[str], url: str = "url", title: str = "title",
           content_type: Column | None = None) -> DataFrame:
    """One row per video source."""
    return one_each(parsed.select(*keep, video_entries(
        F.col("live"), F.col(url), F.col(title), content_type).alias("_all")), keep)


def page_records(pages: DataFrame, keep: list[str], url: str = "url", title: str = "title") -> DataFrame:
    """Text, images and videos of each page from one parse, as arrays beside the columns ``keep``.

    All three are taken from the same container. ``images`` has every candidate
    with its verdict; ``keep`` must hold the URL and the title.
    """
    parsed = parse_pages(pages, keep)
    live = F.col("live")
    return parsed.select(
        *keep, "container_kind", F.array_join(paragraphs(live, F.col("_loose")), "\n\n").alias("text"),
        image_entries(live, F.col(url), F.col(title)).alias("images"),
        video_entries(live, F.col(url), F.col(title)).alias("videos"))
