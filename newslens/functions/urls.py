"""URL and media-name functions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newslens import constants as K
from newslens.functions.text import contains_any, let, safe_title

# a query or fragment mark alone says nothing
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(//[^/?#]*)?([^?#]*)(\?[^#]+)?\??(#.+)?#?$"


def _split_url(url: Column) -> Column:
    """Scheme in lower case, authority with its slashes, path, query and fragment with their marks; empty if absent.

    A part is only looked for where its mark occurs.
    """
    def part(i: int, mark: str) -> Column:
        return F.when(url.contains(mark), F.regexp_extract(url, _PARTS, i)).otherwise("")

    path = F.when(contains_any(url, (":", "//", "?", "#")), F.regexp_extract(url, _PARTS, 3)).otherwise(url)
    return F.struct(F.lower(part(1, ":")).alias("scheme"), part(2, "//").alias("site"), path.alias("path"),
                    part(4, "?").alias("query"), part(5, "#").alias("fragment"))


def _without_dots(segments: Column) -> Column:
    """Fold over path segments: ``.`` goes, ``..`` takes the one before with it, a dot at the end leaves a slash."""
    none = F.array().cast("array<string>")

    def step(done: Column, x: Column) -> Column:
        return (F.when(x == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
                .when(x == ".", done).otherwise(F.concat(done, F.array(x))))

    def folded(parts: Column) -> Column:
        ends = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(none)
        return F.array_join(F.concat(F.aggregate(parts, none, step), ends), "/")

    return let(let(segments, folded), lambda path: F.when(path.startswith("/"), path).otherwise(F.concat(F.lit("/"), path)))


def _joined_path(base: Column, ref: Column) -> Column:
    """Path of a reference: absolute, or below the folder of the base's path.

    Segments are only looked at one by one where some may have to go.
    """
    def named(parts: Column) -> Column:
        """All but the last, without empty ones."""
        return F.array_remove(F.slice(parts, F.lit(1), F.size(parts) - 1), "")

    def below(parts: Column) -> Column:
        return F.concat(F.array(F.lit("")), let(F.split(base, "/"), named), named(parts), F.slice(parts, -1, 1))

    absolute = ref.startswith("/")
    folder = F.left(base, F.length(base) - F.length(F.substring_index(base, "/", -1)))
    plain = F.when(absolute, ref).when(base.startswith("/"), F.concat(folder, ref)).otherwise(
        F.concat(F.lit("/"), folder, ref))
    segments = let(F.split(ref, "/"), lambda parts: F.when(absolute, parts).otherwise(below(parts)))
    return let(plain, lambda path: F.when(
        path.contains("/.") | path.contains("//"), _without_dots(segments)).otherwise(path))


def resolve_url(base: Column, ref: Column) -> Column:
    """Absolute form of ``ref`` seen on page ``base`` (T20), by the rules for URI references.

    Blanks and control signs in front and line breaks inside go first. A reference with a site of its own keeps its
    path as it is; one with another scheme, or seen without a base, stays as it is. A scheme equal to the base's
    counts as absent if no site follows. Square brackets that do not pair leave the reference as it is.
    """
    def clean(url: Column) -> Column:
        return F.regexp_replace(url, r"^[\x00-\x20]+|[\t\r\n]", "")

    def join(both: Column) -> Column:
        b, r = both["b"], both["r"]
        odd = (b["site"].contains("[") != b["site"].contains("]")) | (r["site"].contains("[") != r["site"].contains("]"))
        rest = F.concat(r["query"], r["fragment"])
        same_page = F.concat(b["path"], F.when(r["query"] == "", b["query"]).otherwise(r["query"]), r["fragment"])
        return (F.when(both["raw"] == "", both["base"])
                .when((both["base"] == "") | odd, both["raw"])
                .when((r["scheme"] != "") & (r["scheme"] != b["scheme"]), both["raw"])
                .when(r["site"].rlike("^//."), F.concat(b["scheme"], F.lit(":"), r["site"], r["path"], rest))
                .otherwise(F.concat(b["scheme"], F.lit(":"), b["site"], F.when(r["path"] == "", same_page).otherwise(
                    F.concat(_joined_path(b["path"], r["path"]), rest)))))

    page = F.coalesce(base, F.lit(""))
    # not in a let of its own: the parts of a constant base are then a constant
    whole = F.struct(_split_url(clean(page)).alias("b"), let(clean(ref), _split_url).alias("r"), page.alias("base"),
                     ref.alias("raw"))
    return F.when(ref.isNotNull(), let(whole, join))


def is_video_link(url: Column) -> Column:
    """A player page rather than a file."""
    return contains_any(url, K.VIDEO_LINK_MARKS)


def _first_match(col: Column, table, value_of=lambda mark: mark) -> list:
    return [(col.contains(value_of(mark)), ext) for mark, ext in table]


def _choose(cases, default: str) -> Column:
    chosen = None
    for condition, ext in cases:
        chosen = F.when(condition, ext) if chosen is None else chosen.when(condition, ext)
    return chosen.otherwise(default)


def image_extension(content_type: Column) -> Column:
    return _choose(_first_match(F.coalesce(content_type, F.lit("")), K.IMAGE_EXTENSIONS),
                   K.DEFAULT_IMAGE_EXTENSION)


def video_extension(content_type: Column, url: Column) -> Column:
    """Extension by content type, then by URL, then the default."""
    by_type = _first_match(F.coalesce(content_type, F.lit("")), K.VIDEO_EXTENSIONS)
    by_url = _first_match(url, K.VIDEO_EXTENSIONS, lambda mark: f".{mark}")
    return _choose(by_type + by_url, K.DEFAULT_VIDEO_EXTENSION)


def image_name(title: Column, position: Column, extension: Column) -> Column:
    """``position`` counts from 1."""
    return F.concat(safe_title(title), F.lit("_"), position.cast("string"), F.lit("."), extension)


def background_name(title: Column, position: Column, extension: Column) -> Column:
    return F.concat(safe_title(title), F.lit("_bg_"), position.cast("string"), F.lit("."), extension)


def video_name(title: Column, position: Column, url: Column, extension: Column) -> Column:
    stem = F.concat(safe_title(title), F.lit("_"), position.cast("string"))
    return F.when(is_video_link(url), F.concat(stem, F.lit("_link.txt"))
                  ).otherwise(F.concat(stem, F.lit("."), extension))


def file_format(name: Column) -> Column:
    return F.lower(F.substring_index(name, ".", -1))


def url_host(url: Column) -> Column:
    return F.call_function("try_parse_url", url, F.lit("HOST"))


def url_param(url: Column, key: str) -> Column:
    return F.call_function("try_parse_url", url, F.lit("QUERY"), F.lit(key))
