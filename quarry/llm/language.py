"""Language of web pages by Bayesian evidence fusion: likelihoods of the text and of the declared
markup language, the address suffix, and host priors smoothed along the address hierarchy."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_texts, checkpointed, column_type, lower_ascii, map_arrow, slices
from quarry.llm.url_rules import url_host

#: The languages told apart.
LANGUAGES = ("de", "en", "es", "fr")
#: Country suffixes -> language (fixed values).
SUFFIX_LANGUAGE = {"de": "de", "at": "de", "ch": "de", "uk": "en", "us": "en", "au": "en", "ie": "en", "nz": "en",
                   "es": "es", "mx": "es", "ar": "es", "cl": "es", "fr": "fr", "be": "fr"}
#: Bounds of the fit: texts of each language, and hashed byte trigrams.
TEXTS, BUCKETS = 400, 1 << 15
#: Pseudo-pages that a parent's prior counts for at each level, and that a country suffix adds.
STRENGTH, SUFFIX_PAGES = 4.0, 4.0
#: Neighbouring trigrams tell the same story: a text counts as a third of its trigrams.
INDEPENDENCE = 1 / 3

#: Markup, code, and parts that are seldom in the page's own language: what opens them, and what
#: closes those that reach beyond their own tag.
_OPENING = re.compile(rb"(?i)<(?P<name>script|style|noscript|nav|aside|footer)\b|(?P<note><!--)|(?P<ad><div class=[\"']ad[\"'])"
                      rb"|(?P<tag><)|&[a-z0-9#]{1,10};")
_CLOSING = {**{n: re.compile(rb"(?i)</%s\s*>" % n) for n in (b"script", b"style", b"noscript", b"nav", b"aside", b"footer")},
            b"<!--": re.compile(b"-->"), b"ad": re.compile(rb"(?i)</div>")}
_HTML = re.compile(rb"(?i)<html\b")
_LANG = re.compile(rb"""(?i)\slang\s*=\s*["']?\s*([a-z]{2,8})""")


def visible(page: bytes) -> bytes:
    """A page's text, each hidden part as one space. What has no end is hidden as a tag alone, or, if
    no ``>`` follows either, is text. An end that isn't found is not looked for again, so a page
    is read once whatever it holds."""
    out, pos, kept = [], 0, 0
    missing: set[bytes] = set()
    while found := _OPENING.search(page, pos):
        kind = found["name"].lower() if found["name"] else b"<!--" if found["note"] else b"ad" if found["ad"] else b""
        stop = None
        if kind and kind not in missing:
            end = _CLOSING[kind].search(page, found.end())
            if end:
                stop = end.end()
            else:
                missing.add(kind)
        if stop is None and page[found.start()] == 60:  # <
            end = -1 if b">" in missing else page.find(b">", found.start())
            if end < 0:
                missing.add(b">")
            else:
                stop = end + 1
        elif stop is None:
            stop = found.end()
        if stop is None:
            pos = found.start() + 1
            continue
        out.append(page[kept:found.start()])
        pos = kept = stop
    out.append(page[kept:])
    return b" ".join(out)


def declared_language(page: bytes) -> str | None:
    """The language in the page's ``html`` tag."""
    pos = 0
    while tag := _HTML.search(page, pos):
        pos = page.find(b">", tag.end())
        pos = len(page) if pos < 0 else pos
        found = _LANG.search(page, tag.end(), pos)
        if found:
            return found[1].lower().decode()
    return None


def buckets(text: bytes) -> np.ndarray:
    """Hashed trigrams of a text's lower-cased bytes, all but letters as one space."""
    raw = np.frombuffer(lower_ascii(text), np.uint8)
    raw = np.where((raw >= 97) & (raw <= 122) | (raw >= 128), raw, 32).astype(np.uint32)
    if len(raw):
        raw = raw[np.concatenate(([True], (raw[1:] != 32) | (raw[:-1] != 32)))]
    if len(raw) < 3:
        return np.zeros(0, np.int64)
    code = (raw[:-2] << np.uint32(16)) | (raw[1:-1] << np.uint32(8)) | raw[2:]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def trigram_counts(docs: DataFrame, lang: str = "lang", text: str = "text", texts: int = TEXTS) -> np.ndarray:
    """language x bucket counts over at most about ``texts`` texts of each language, chosen by a
    hash of the text; counted in the tasks, so no text reaches the driver."""
    known = docs.filter(F.col(lang).isin(*LANGUAGES))
    sizes = {r[0]: r[1] for r in known.groupBy(lang).agg(F.count("*")).collect()}
    mark = F.pmod(F.xxhash64(text), F.lit(1 << 20))
    share = F.coalesce(*[F.when(F.col(lang) == k, F.lit(int((1 << 20) * texts / n) + 1)) for k, n in sizes.items()],
                       F.lit(0))

    def count(batches):
        totals = np.zeros((len(LANGUAGES), BUCKETS), np.int64)
        for batch in slices(batches):
            for k, t in zip(batch.column(lang).to_pylist(), byte_texts(batch, text)):
                totals[LANGUAGES.index(k)] += np.bincount(buckets(t), minlength=BUCKETS)
        flat = totals.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], names=["cell", "n"])

    out = np.zeros(len(LANGUAGES) * BUCKETS)
    found = map_arrow(known.filter(mark < share).select(lang, text), count, "cell long, n long")
    for r in found.groupBy("cell").agg(F.sum("n").alias("n")).collect():  # at most one row a cell
        out[r["cell"]] = r["n"]
    return out.reshape(len(LANGUAGES), BUCKETS)


def log_likelihoods(counts: np.ndarray) -> np.ndarray:
    """log P(trigram | language), smoothed towards all languages together."""
    shared = (counts.sum(axis=0) + 0.5) / (counts.sum() + 0.5 * BUCKETS)
    return np.log((counts + 100 * shared) / (counts.sum(axis=1, keepdims=True) + 100)).astype(np.float32)


def page_evidence(pages: DataFrame, table: np.ndarray, id_col: str, url: str, html: str) -> DataFrame:
    """(id, host, domain, suffix, declared, text array<double>) of every page: ``text`` has the
    log likelihood of the visible text for each language, ``declared`` the markup's language
    (other and none where it isn't one of ours)."""
    sent = pages.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        for batch in slices(batches):
            declared, scores = [], []
            for page in byte_texts(batch, html):
                name = (declared_language(page) or "none")
                name = name if name == "none" else name[:2]
                declared.append(name if name in LANGUAGES or name == "none" else "other")
                hits = buckets(visible(page))
                total = np.bincount(hits, minlength=BUCKETS) if len(hits) > BUCKETS else None
                score = sent.value @ total if total is not None else sent.value[:, hits].sum(axis=1, dtype=np.float64)
                scores.append((score * INDEPENDENCE).tolist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("url"), pa.array(declared, pa.string()),
                 pa.array(scores, pa.list_(pa.float64()))], names=["id", "url", "declared", "text"])

    rows = map_arrow(pages.select(F.col(id_col).alias("id"), F.col(url).alias("url"), F.col(html).alias(html)), run,
                     f"id {column_type(pages, id_col)}, url string, declared string, text array<double>")
    labels = F.split(F.regexp_replace(url_host(F.col("url")), r":\d*$", ""), r"\.")
    n = F.size(labels)
    return rows.select(
        "id", F.array_join(labels, ".").alias("host"),
        F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), 2), ".").alias("domain"),
        F.element_at(labels, -1).alias("suffix"), "declared", "text")


def softmax(logs: Column) -> Column:
    top = F.array_max(logs)
    powers = F.transform(logs, lambda x: F.exp(x - top))
    return F.transform(powers, lambda x: x / F.aggregate(powers, F.lit(0.0), lambda a, b: a + b))


def _add(a: Column, b: Column, scale: float = 1.0) -> Column:
    return F.zip_with(a, b, lambda x, y: x + F.lit(scale) * y)


def declared_likelihoods(evidence: DataFrame) -> Column:
    """log P(declared | language) from the texts' posteriors, as an expression of ``declared``."""
    sums = [F.sum(F.col("belief")[i]).alias(str(i)) for i in range(len(LANGUAGES))]
    seen = {r["declared"]: [r[str(i)] for i in range(len(LANGUAGES))]
            for r in evidence.withColumn("belief", softmax(F.col("text"))).groupBy("declared").agg(*sums).collect()}
    names = [*LANGUAGES, "other", "none"]
    counts = np.array([seen.get(k, [0.0] * len(LANGUAGES)) for k in names]) + 0.5
    logs = np.log(counts / counts.sum(axis=0))
    return F.coalesce(*[F.when(F.col("declared") == k, F.array(*[F.lit(float(x)) for x in row]))
                        for k, row in zip(names, logs)])


def _level(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """Belief sums of one level of the hierarchy as an array column."""
    sums = [F.sum(F.col("belief")[i]) for i in range(len(LANGUAGES))]
    return rows.groupBy(*keys).agg(F.array(*sums).alias(name))


def identify(pages: DataFrame, docs: DataFrame, id_col: str = "page_id", url: str = "url", html: str = "html",
             lang: str = "lang", text: str = "text", texts: int = TEXTS) -> DataFrame:
    """(id, language, confidence, declared, text_language, host, beliefs) for every row of ``pages``.

    ``docs`` (``lang``, ``text``) teach the text likelihoods, ``texts`` of each language. A page's prior is its host's share of
    each language, smoothed towards the domain's, that towards the suffix', and that towards all
    pages' (a country suffix adds pages of its language); the page's own part is taken out of all
    of them. The sums are grouped aggregations of the hosts' sums, so a host with a third of the
    pages is summed in the tasks first. Pages without a host have the prior of all pages. Null
    and empty markup gives no text evidence and none declared. Null and repeated ids keep their
    rows; extra columns are unused. A page is read once, whatever its length or broken markup.
    """
    table = log_likelihoods(trigram_counts(docs, lang, text, texts))
    evidence = checkpointed(page_evidence(pages, table, id_col, url, html))
    logs = _add(F.col("text"), declared_likelihoods(evidence))
    rows = evidence.withColumn("logs", logs).withColumn("belief", softmax(F.col("logs")))
    zero = F.array(*[F.lit(0.0)] * len(LANGUAGES))
    hosts = checkpointed(_level(rows, ["host", "domain", "suffix"], "host_sum"))
    whole = hosts.agg(*[F.sum(F.col("host_sum")[i]) for i in range(len(LANGUAGES))]).first()
    everything = F.array(*[F.lit(float(x or 0.0)) for x in whole])
    named = hosts.filter("host <> ''").withColumnRenamed("host_sum", "belief")
    domains = _level(named, ["domain", "suffix"], "domain_sum")
    suffixes = _level(domains.withColumnRenamed("domain_sum", "belief"), ["suffix"], "suffix_sum")
    tree = (named.withColumnRenamed("belief", "host_sum").join(domains, ["domain", "suffix"])
            .join(suffixes, "suffix").select("host", "host_sum", "domain_sum", "suffix_sum"))
    country = F.coalesce(*[F.when(F.col("suffix") == s, F.array(*[F.lit(SUFFIX_PAGES * (k == lang_)) for lang_ in LANGUAGES]))
                           for s, k in SUFFIX_LANGUAGE.items()], zero)
    total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
    smooth = lambda own, parent: F.transform(
        F.zip_with(own, parent, lambda x, p: F.greatest(x, F.lit(0.0)) + STRENGTH * p),
        lambda x: x / (total(F.transform(own, lambda y: F.greatest(y, F.lit(0.0)))) + STRENGTH))
    flat = F.array(*[F.lit(1.0 / len(LANGUAGES))] * len(LANGUAGES))
    out = rows.join(tree, "host", "left")
    out = out.withColumn("prior", smooth(_add(everything, F.col("belief"), -1.0), flat))
    for level in ("suffix_sum", "domain_sum", "host_sum"):
        others = _add(F.col(level), F.col("belief"), -1.0)
        if level == "suffix_sum":
            others = _add(others, country)
        out = out.withColumn("prior", F.when(F.col(level).isNull(), F.col("prior")).otherwise(
            smooth(others, F.col("prior"))))
    out = out.withColumn("beliefs", softmax(F.zip_with("logs", "prior", lambda x, p: x + F.log(p))))
    names = F.array(*[F.lit(k) for k in LANGUAGES])
    best = lambda a: F.element_at(names, F.array_position(a, F.array_max(a)).cast("int"))
    return out.select(
        F.col("id").alias(id_col), best(F.col("beliefs")).alias("language"),
        F.array_max("beliefs").alias("confidence"), "declared",
        F.when(F.array_max("text") == F.array_min("text"), F.lit(None)).otherwise(best(F.col("text"))).alias("text_language"),
        "host", "beliefs")
