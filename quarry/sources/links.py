"""Link discovery and landing bookkeeping, as column
expressions over a ``pages(page_id, url, html)`` frame -- no HTML parser, no
per-row Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Anchor text of the download link, the document host and the
# export suffix used to turn a document link into a CSV export link.
DOWNLOAD_TEXT = "Download the index"
DOC_HOST = "docs.google.com"
EXPORT_SUFFIX = "/export?format=csv"

# Elements that have no content, and those whose content is raw text.
VOID = ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr")
RAW = ("script", "style")
# The named character references that are decoded, beside all numeric ones.
NAMED = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "amp": "&", "nbsp": "\u00a0"}

# A page's tokens, in this order: comments (an open one reaches to the end), raw elements with
# their text, end tags, start tags (quoted values may hold ">", a stray quote ends with the tag),
# declarations, text. Loops are possessive or single characters, so none recurses; only what stands
# before the last ">" is cut, so no search for the end of a tag runs in vain.
_RAW = "|".join(RAW)
TOKEN = (r"(?s)<!--.*?(?:-->|\z)"
         rf"|(?i:<(?:{_RAW})(?:\s[^>]*+)?>).*?(?=(?i:</(?:{_RAW})\b)|\z)"
         r"|</[a-zA-Z][^>]*+>"
         r"""|<[a-zA-Z](?:[^>"']|"[^"]{0,8192}+"|'[^']{0,8192}+'){0,4096}+>"""
         r"|<[a-zA-Z][^>]*+>"
         r"|<[!?/][^>]*+>"
         r"|(?:[^<]|<(?![a-zA-Z!?/]))++"
         r"|<")
# Names and values of a start tag; a value is consumed with its name, so nothing inside it counts.
_NAME = r"(?<=[\s/\"'])([^\s/>=\"'][^\s/>=]*+)"
_VALUE = r"""(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?)?"""
_ATTRIBUTE = _NAME + _VALUE
_REFERENCE = r"&(?:#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[a-zA-Z]+);?"


def _character(ref: Column) -> Column:
    """The character of one reference; one that is not known stays as it is."""
    name = F.regexp_replace(ref, "[&;]", "")
    digits = F.regexp_extract(ref, "[0-9a-fA-F]+", 0)
    number = F.when(F.lower(ref).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    valid = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    coded = F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")
    known = F.try_element_at(F.create_map(*[F.lit(x) for kv in NAMED.items() for x in kv]), name)
    return F.when(ref.startswith("&#"), F.when(valid, coded).otherwise(F.lit("\ufffd"))).otherwise(F.coalesce(known, ref))


def unescape(c: Column) -> Column:
    """Text with its character references decoded, once and from left to right."""
    refs = F.regexp_extract_all(c, F.lit(_REFERENCE), 0)
    plain = F.split(c, _REFERENCE, -1)
    parts = F.zip_with(plain, refs, lambda t, r: F.concat(t, F.when(r.isNull(), F.lit("")).otherwise(_character(r))))
    return F.when(c.contains("&"), F.array_join(parts, "")).otherwise(c)


def tokens(html: Column, text: str) -> Column:
    """The page as array<struct<kind, name, href, said>>: ``open`` and ``close`` tags, ``leaf`` elements
    and ``text``; ``href`` is the last one of a start tag, decoded, and ``said`` tells whether a
    text (or comment) is ``text`` once decoded."""
    def read(t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, r"\A</?([a-zA-Z][^\s/>]*+)", 1))
        comment = t.startswith("<!--")
        end, start = t.rlike(r"\A</[a-zA-Z]"), t.rlike(r"\A<[a-zA-Z]") & t.endswith(">")
        raw = name.isin(*RAW) & ~end
        leaf = start & (name.isin(*VOID) | t.endswith("/>"))
        kind = (F.when(end, "close").when(raw, "open").when(leaf, "leaf").when(start, "open").otherwise("text"))
        names = F.transform(F.regexp_extract_all(t, F.lit(_ATTRIBUTE), 1), lambda x: F.lower(x))
        values = F.regexp_extract_all(t, F.lit(_ATTRIBUTE), 2)
        at = F.size(names) + 1 - F.array_position(F.reverse(names), "href")
        value = F.try_element_at(values, F.when(F.array_contains(names, "href"), at).cast("int"))
        bare = F.when(value.rlike(r"(?s)\A[\"']"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)
        href = F.when((name == "a") & start, unescape(bare))
        content = F.when(comment, F.regexp_replace(t, r"(?s)\A<!--|-->\z", "")).otherwise(unescape(t))
        said = F.when(kind == "text", F.when(F.length(t) <= 12 * len(text) + 8, content == text).otherwise(F.lit(False)))
        return F.struct(kind.alias("kind"), name.alias("name"), href.alias("href"),
                        F.coalesce(said, F.lit(False)).alias("said"))
    rest = F.substring_index(html, ">", -1)
    marked = F.substring(html, F.lit(1), F.length(html) - F.length(rest))
    pieces = F.concat(F.regexp_extract_all(marked, F.lit(TOKEN), 0),
                      F.when(rest == "", F.array().cast("array<string>")).otherwise(F.array(rest)))
    return F.transform(pieces, read)


_ELEMENT = "struct<name:string,href:string,start:int,kids:int,said:boolean>"
_FOUND = "struct<start:int,href:string>"


def _earlier(a: Column, b: Column) -> Column:
    return F.when(b.isNull() | (a["start"] <= b["start"]), a).otherwise(b)


def _close(state: Column, upto: Column) -> Column:
    """The state once the ``upto`` innermost open elements are closed. An element says the text if
    its only child does."""
    def shut(s: Column, e: Column) -> Column:
        said = F.when(s["first"], e["said"]).otherwise(s["said"] & (e["kids"] == 1))
        hit = F.struct(e["start"].alias("start"), e["href"].alias("href"))
        found = F.when(said & (e["name"] == "a"), _earlier(hit, s["found"])).otherwise(s["found"])
        return F.struct(F.lit(False).alias("first"), said.alias("said"), found.alias("found"))
    done = F.aggregate(F.slice(state["open"], F.lit(1), upto),
                       F.struct(F.lit(True).alias("first"), F.lit(False).alias("said"), state["found"].alias("found")), shut)
    rest = F.slice(state["open"], upto + 1, F.greatest(F.size(state["open"]) - upto, F.lit(0)))
    # The element around the closed ones says the text if they were its only child.
    around = F.transform(rest, lambda e, i: F.when(i == 0, _element(
        e["name"], e["href"], e["start"], e["kids"], done["said"] & (e["kids"] == 1))).otherwise(e))
    return _state(state["at"] + 1, around, done["found"])


def _element(name, href, start, kids, said) -> Column:
    return F.struct(name.alias("name"), href.alias("href"), start.alias("start"), kids.alias("kids"), said.alias("said"))


def _state(at, stack, found) -> Column:
    return F.struct(at.alias("at"), stack.alias("open"), found.alias("found"))


def _child(stack: Column, said: Column) -> Column:
    """The open elements once the innermost has one more child, which says the text or doesn't."""
    return F.transform(stack, lambda e, i: F.when(i == 0, _element(
        e["name"], e["href"], e["start"], e["kids"] + 1, said & (e["kids"] == 0))).otherwise(e))


def first_link_with_text(html: str | Column, text: str = DOWNLOAD_TEXT) -> Column:
    """Href of the first anchor whose only string is ``text``, as an HTML parser finds it:
    directly or in a chain of only children; null if there is none or it has no href.

    The page is cut into tokens and folded once, with the elements that are open as the state.
    Comments and scripts are no markup, an end tag closes what is open inside its element, and
    stray end tags are ignored. Only pages that can hold the text are cut.
    """
    h = F.col(html) if isinstance(html, str) else html
    start = _state(F.lit(0), F.array().cast(f"array<{_ELEMENT}>"), F.lit(None).cast(_FOUND))

    def step(state: Column, t: Column) -> Column:
        new = _element(t["name"], t["href"], state["at"], F.lit(0), F.lit(False))
        depth = F.array_position(F.transform(state["open"], lambda e: e["name"]), t["name"]).cast("int")
        opened = _state(state["at"] + 1, F.concat(F.array(new), _child(state["open"], F.lit(False))), state["found"])
        inside = _state(state["at"] + 1, _child(state["open"], t["said"]), state["found"])
        stray = _state(state["at"] + 1, state["open"], state["found"])
        return (F.when(t["kind"] == "open", opened).when(t["kind"] != "close", inside)
                .when(depth == 0, stray).otherwise(_close(state, depth)))

    def end(state: Column) -> Column:
        return F.nullif(_close(state, F.size(state["open"]))["found"]["href"], F.lit(""))
    return F.when(h.contains(text) | h.contains("&"), F.aggregate(tokens(h, text), start, step, end))


def download_links(pages: DataFrame, text: str = DOWNLOAD_TEXT) -> DataFrame:
    """(page_id, url, href) for pages that have the link; others are skipped."""
    return (pages.select("page_id", "url", first_link_with_text("html", text).alias("href"))
            .filter(F.col("href").isNotNull()))


def export_link(url: str | Column, host: str = DOC_HOST, exclude: str = "export",
                cut: str = "/edit", suffix: str = EXPORT_SUFFIX) -> Column:
    """If the link points at ``host`` and is not already an export link, keep
    the part before the first ``cut`` and append ``suffix``."""
    u = F.col(url) if isinstance(url, str) else url
    rewrite = u.contains(host) & ~u.contains(exclude)
    return F.when(rewrite, F.concat(F.substring_index(u, cut, 1), F.lit(suffix))).otherwise(u)


def not_yet_landed(candidates: DataFrame, landed: DataFrame, key: str) -> DataFrame:
    """Candidates whose key is absent from the manifest of landed inputs."""
    return candidates.join(landed.select(key).distinct(), key, "left_anti")
