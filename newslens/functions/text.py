"""Column functions over article files: header, body, media lists, names.

All of them are built-in expressions; none needs Python workers.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from newslens import constants as K


def strip(col: Column) -> Column:
    """Remove all leading and trailing white space, not only blanks."""
    return F.regexp_replace(F.regexp_replace(col, rf"\A{K.BLANK}+", ""), rf"{K.BLANK}+\z", "")


def contains_any(col: Column, marks) -> Column:
    found = F.lit(False)
    for mark in marks:
        found = found | col.contains(mark)
    return found


def has_cjk(col: Column) -> Column:
    return col.rlike(K.CJK)


def base_name(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def title_from_file_name(name: Column) -> Column:
    """Every occurrence of the extension goes, wherever it stands."""
    return F.replace(name, F.lit(".txt"), F.lit(""))


def safe_title(title: Column) -> Column:
    """Title without the characters that file systems refuse."""
    return F.regexp_replace(title, K.UNSAFE_IN_FILE_NAMES, "")


def _after(text: Column, prefix: str) -> Column:
    return F.regexp_extract(text, rf"{prefix} ([^\n]+)", 1)


def header_title(text: Column, file_name: Column) -> Column:
    found = _after(text, K.TITLE_PREFIX)
    return F.when(found == "", file_name).otherwise(strip(found))


def header_url(text: Column) -> Column:
    return strip(_after(text, K.URL_PREFIX))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    Inside a lambda this matters most: an expression written there runs again
    for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


_HEADER_LINE = rf"(?:{K.TITLE_PREFIX}|{K.URL_PREFIX})[^\n]*+(?:\n|\z)"
_SKIPPED = rf"\A(?:{_HEADER_LINE}|{K.BLANK}*\n)*+(?:{K.BLANK}+\z)?"


def _first_of(text: Column, *marks: str) -> Column:
    """Position of the earliest mark, counted from 1, or NULL."""
    return F.array_min(F.filter(F.array(*[F.instr(text, mark) for mark in marks]), lambda at: at > 0))


def body_by_lines(text: Column) -> Column:
    """Lines from the first one that is neither blank nor header up to a media list.

    A file with nothing but a header keeps it: the start then stays at line one.
    """
    def cut(parts: Column) -> Column:
        whole, skipped, mark = parts["text"], parts["skipped"], parts["mark"]
        start = F.when(skipped == F.length(whole), 0).otherwise(skipped)
        # the line with the mark is left out together with the line break before it
        line_head = F.length(F.substring_index(F.substring(whole, F.lit(1), mark - 1), "\n", -1))
        stop = mark - 2 - line_head
        return F.when(mark.isNull(), F.substring(whole, start + 1, F.length(whole))).otherwise(
            F.substring(whole, start + 1, F.greatest(stop - start, F.lit(0))))

    return let(F.struct(
        text.alias("text"), F.length(F.regexp_extract(text, _SKIPPED, 0)).alias("skipped"),
        _first_of(text, K.IMAGE_LIST, K.VIDEO_LIST).alias("mark")), cut)


def content_by_rules(text: Column) -> Column:
    """Text without header, image list and trailing sections, not yet stripped.

    A video list goes only when an image list stands before it.
    """
    sections = "|".join(K.TRAILING_SECTIONS)
    text = F.regexp_replace(text, rf"{K.TITLE_PREFIX} [^\n]+\n{K.URL_PREFIX} [^\n]+\n\n", "")
    text = F.regexp_replace(text, rf"(?s){K.IMAGE_LIST}.*", "")
    return F.regexp_replace(text, rf"(?s)\n(?:{sections})\n.*", "")


def media_list(text: Column) -> Column:
    """Image and video lines of an article file as an array of structs.

    Accepts either colon width and either list, in whichever order they stand.
    Only the text from the first list heading on is searched.
    """
    heads = K.IMAGE_LIST[:-1], K.VIDEO_LIST[:-1]
    # titles, and so file names, can be very long: the size is looked for from its
    # own label, not by trying every place where the name might end
    size = rf" - {K.SIZE_LABEL[:-1]}[:：] (\d+x\d+)\s*\z"

    def number(col: Column) -> Column:
        return F.nullif(col, F.lit("")).cast("int")

    def section(tail: Column, head: str, other: str, kind: str) -> Column:
        chunk = F.regexp_extract(tail, rf"(?s)(?:\A|\n){head}[:：](.*?)(?:\n{other}[:：]|\z)", 1)
        lines = F.transform(F.split(chunk, "\n"), lambda x: F.struct(
            x.alias("line"), F.regexp_extract(x, r"^(\d+)\. ", 1).alias("pos"),
            F.regexp_extract(x, size, 1).alias("size")))
        items = F.transform(F.filter(lines, lambda x: x["pos"] != ""), lambda x: F.struct(
            number(x["pos"]).alias("pos"),
            F.lit(kind).alias("kind"),
            F.regexp_replace(F.substring(x["line"], F.length(x["pos"]) + 3, F.length(x["line"])),
                             rf"(?:{size})|\s+\z", "").alias("file_name"),
            number(F.substring_index(x["size"], "x", 1)).alias("width"),
            number(F.substring_index(x["size"], "x", -1)).alias("height"),
        ))
        return F.filter(items, lambda x: x["file_name"] != "")

    first = F.coalesce(_first_of(text, *heads), F.length(text) + 1)
    # one character more, so that the heading's own line break is seen
    return let(F.substring(text, F.greatest(first - 1, F.lit(1)), F.length(text)), lambda tail: F.concat(
        section(tail, *heads, "image"), section(tail, *heads[::-1], "video")))


def article_text(title: Column, url: Column, body: Column, images: Column, videos: Column) -> Column:
    """One article file (K5): the inverse of the header, body and list readers.

    ``images`` is an array of (file_name, width, height), ``videos`` of (file_name).
    """
    image_rows = F.transform(images, lambda x, i: F.concat(
        (i + 1).cast("string"), F.lit(". "), x["file_name"], F.lit(f" - {K.SIZE_LABEL} "),
        x["width"].cast("string"), F.lit("x"), x["height"].cast("string"), F.lit("\n"),
    ))
    video_rows = F.transform(videos, lambda x, i: F.concat(
        (i + 1).cast("string"), F.lit(". "), x["file_name"], F.lit("\n")))

    def listed(marker: str, rows: Column) -> Column:
        return F.when(F.size(rows) > 0, F.concat(F.lit(f"\n\n{marker}\n"), F.array_join(rows, ""))
                      ).otherwise("")

    return F.concat(
        F.lit(f"{K.TITLE_PREFIX} "), title, F.lit(f"\n{K.URL_PREFIX} "), url, F.lit("\n\n"), body,
        listed(K.IMAGE_LIST, image_rows), listed(K.VIDEO_LIST, video_rows),
    )


def guessed_image_url(title: Column, text: Column) -> Column:
    """First image path by naming rule, present only with an image list."""
    return F.when(text.contains(K.IMAGE_LIST), F.concat(F.lit("images/"), title, F.lit("_1.jpg")))


def shown(title: Column, width: int = 50) -> Column:
    return F.substring(title, 1, width)
