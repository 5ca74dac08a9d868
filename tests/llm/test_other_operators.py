"""Language, toxicity, quality, top-k, decontamination, URL rules and the pipeline."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from quarry.llm import decontaminate, language, quality, topk, toxicity, url_rules
from quarry.llm.labelled import held_out, labelled_sample
from quarry.llm.queries import LISTED, ORACLE, PATTERNS, QUERIES, read

SMOKE, SMALL = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
EXTRA = "doc_id long, text string, score double, predicted int, label int, neighbours string"


def edge_docs(spark):
    rows = [(1, None), (2, ""), (None, "idiot"), (3, "you idiot " * 3), (3, "you idiot " * 3), (4, "fine words " * 60_000)]
    return spark.createDataFrame([(i, t, 9.0, 9, 9, "z") for i, t in rows], EXTRA)


# --- classifiers ---

def test_held_out_split(spark):
    ids = [0, 1, 7, 12345678901, -4]
    got = spark.createDataFrame([(i,) for i in [*ids, None]], "i long").select("i", held_out("i").alias("h")).collect()
    assert {r.i: r.h for r in got} == {**{i: zlib.crc32(str(i).encode()) % 5 == 0 for i in ids}, None: False}


def test_labelled_sample_is_bounded_and_never_held_out(spark):
    sample = labelled_sample(read(spark, SMALL, "documents"), read(spark, SMALL, "labels"), "toxic", 20)
    assert sample.labels.count(0) == 20 and sample.labels.count(1) == 20 and sample.totals[0] > 200
    assert all(zlib.crc32(str(i).encode()) % 5 for i in sample.ids)


@pytest.mark.parametrize("name, label, least", [("op4_toxicity", "toxic", 0.95), ("op6_quality", "quality", 0.95)])
def test_held_out_accuracy(spark, name, label, least):
    out = QUERIES[name](spark, SMALL)
    assert out.count() == 1000
    rows = out.join(read(spark, SMALL, "labels"), "doc_id").filter("held_out").collect()
    assert len(rows) > 50
    assert np.mean([r.predicted == r[label] for r in rows]) >= least
    assert all(0 <= r.score <= 1 for r in rows)
    yes = np.mean([r.score for r in rows if r[label] == 1])
    assert yes > np.mean([r.score for r in rows if r[label] == 0]) + 0.4


def test_toxicity_edge_cases(spark):
    labels = read(spark, SMALL, "labels")
    model = toxicity.fit(read(spark, SMALL, "documents"), labels)
    out = toxicity.score_toxicity(edge_docs(spark), labels, model=model).collect()
    assert len(out) == 6
    by = {r.doc_id: r for r in out}
    assert by[1].score == by[2].score < 0.5 and by[3].predicted == 1 and by[None].predicted == 1
    assert by[3].neighbours and all(n.label == 1 for n in by[3].neighbours) and "idiot" in by[3].terms
    none = labels.limit(0)
    assert toxicity.score_toxicity(edge_docs(spark), none).filter("predicted = 1").count() == 0
    assert toxicity.drop_toxic(read(spark, SMOKE, "documents").limit(0), none).count() == 0


def test_block_max_search_is_exact():
    rng = random.Random(8)
    vectors = []
    for _ in range(300):
        v = {rng.randrange(40): rng.random() for _ in range(rng.randrange(6))}
        norm = sum(x * x for x in v.values()) ** 0.5
        vectors.append({f: x / norm for f, x in v.items()})
    index = toxicity.BlockMaxIndex(vectors, 40, block=16)
    for q in vectors[:60]:
        want = sorted(((sum(q[f] * v.get(f, 0) for f in q), i) for i, v in enumerate(vectors)), key=lambda x: (-x[0], x[1]))
        want = [w for w in want if w[0] > 0][:7]
        got = index.search(q, 7)
        assert np.allclose([g[0] for g in got], [w[0] for w in want])
        assert {i for s, i in got if s > got[-1][0] + 1e-9} == {i for s, i in want if s > want[-1][0] + 1e-9} if got else not want


def test_toxicity_neighbours_by_all_words(spark):
    """A word that one example holds finds it, and words that tell nothing alone dilute the others."""
    rng = random.Random(4)
    said = lambda n: " ".join(f"w{rng.randrange(60)}" for _ in range(n))
    rows = [(i, said(30) + (" vile" if i % 4 == 0 else "") + (" zonker" if i == 400 else "")) for i in range(1, 601)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert 400 in model.ids and all(len(model.vocabulary.counts(w.encode())[0]) for i, t in rows if i in model.ids for w in t.split())
    (_, rare, _), (_, alone, terms), (_, among, _) = model.score_all([b"Zonker!", b"vile", f"vile {said(400)}".encode()])
    assert [model.ids[e] for _, e in rare] == [400]
    assert terms == [b"vile", b"vile*"] and among[0][0] < 0.99 and all(model.labels[e] for _, e in alone)
    counts = [model.vocabulary.counts(t.encode()) for _, t in rows[:20]]
    weigh = lambda c: dict(zip(c[0].tolist(), ((1 + np.log(c[1])) * model.value[c[0]]).tolist()))
    cosine = lambda a, b: sum(x * b.get(f, 0) for f, x in a.items()) / (sum(x * x for x in a.values()) * sum(x * x for x in b.values())) ** 0.5
    by_id = dict(rows)
    examples = [weigh(model.vocabulary.counts(by_id[i].encode())) for i in model.ids]
    for c, near in zip(counts, model.neighbours(counts)):
        want = sorted((cosine(weigh(c), e) for e in examples), reverse=True)[:toxicity.NEIGHBOURS]
        assert np.allclose([s for s, _ in near], want)


def test_quality_edge_cases(spark):
    labels = read(spark, SMALL, "labels")
    model = quality.fit(read(spark, SMALL, "documents"), labels)
    out = quality.score_quality(edge_docs(spark), labels, model=model).collect()
    assert len(out) == 6 and all(0 <= r.score <= 1 for r in out)
    by = {r.doc_id: r for r in out}
    assert by[1].score == by[2].score
    assert {r.score for r in quality.score_quality(edge_docs(spark), labels.limit(0)).collect()} == {0.5}


def test_quality_fit_learns_from_all_passages(spark, monkeypatch):
    rows = [(i, "Some words of a text. " * (900 if i % 7 == 0 else 20)) for i in range(1, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i, _ in rows], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality.Attention, "fit", lambda self, x, counts, y, weight: seen.append((len(x), counts.tolist())))
    quality.fit(docs, labels)
    want = [int(quality.passages([t.encode()])[1][0]) for i, t in rows if zlib.crc32(str(i).encode()) % 5]
    assert seen == [(sum(want), want)] and max(want) > 48


def test_quality_score_does_not_depend_on_neighbours():
    model = quality.Attention()
    texts = [b"Some words here.", b"", b"x | y | z " * 200, b"!!! ### " * 50]
    alone = [model.score([t])[0][0] for t in texts]
    assert np.allclose(alone, [s for s, _, _ in model.score(texts)], atol=1e-5)


def test_attention_gradients():
    rng = np.random.default_rng(1)
    model = quality.Attention()
    model.p = {k: v.astype(np.float64) for k, v in model.p.items()}
    x, counts = rng.random((9, quality.N_FEATURES)), np.array([4, 2, 3])
    y, weight = np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 0.5])

    def loss():
        p = model.forward(x, counts)["p"]
        return -(weight * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / weight.sum()
    grads = model.gradients(model.forward(x, counts), y, weight)
    for k in ("V", "U", "w", "c", "d", "e"):
        at = tuple(rng.integers(0, s) for s in model.p[k].shape)
        model.p[k][at] += 1e-5
        up = loss()
        model.p[k][at] -= 2e-5
        slope = (up - loss()) / 2e-5
        model.p[k][at] += 1e-5
        assert abs(slope - grads[k][at]) < 1e-4


def test_language_of_pages(spark):
    rows = QUERIES["op1_language_id"](spark, SMALL).join(read(spark, SMALL, "pages"), "page_id").collect()
    assert len(rows) == 250
    right = [r.language == r.url.split("://")[1].split("/")[1] for r in rows]
    assert np.mean(right) > 0.97 and all(abs(sum(r.beliefs) - 1) < 1e-9 for r in rows)


def test_language_edge_cases(spark):
    docs = read(spark, SMALL, "documents")
    pages = spark.createDataFrame(
        [(1, None, None, 1), (2, "", "", 1), (None, "http://a.de/x", "<html lang=de>", 1), (3, "http://b.x.fr/", "", 1),
         (3, "http://b.x.fr/", "", 1), (4, "http://c.com", "<html><p>" + "the and of with " * 50_000, 1), (5, "no host", "<html lang='zz'>", 1)],
        "page_id long, url string, html string, host int")
    out = language.identify(pages, docs).collect()
    assert len(out) == 7
    by = {r.page_id: r for r in out}
    assert by[None].language == "de" and by[3].language == "fr" and by[4].language == "en"
    assert by[5].declared == "other" and by[2].text_language is None
    assert language.identify(pages.limit(0), docs).count() == 0


# --- markup ---

def test_visible_text_equals_the_lazy_pattern():
    import re

    lazy = re.compile(rb"(?is)<(script|style|noscript|nav|aside|footer)\b.*?</\1\s*>|<!--.*?-->"
                      rb"|<div class=[\"']ad[\"'].*?</div>|<[^>]*>|&[a-z0-9#]{1,10};")
    html = re.compile(rb"""(?is)<html\b[^>]*?\slang\s*=\s*["']?\s*([a-z]{2,8})""")
    rng = random.Random(6)
    bits = [b"<script ", b"</script >", b"<STYLE>", b"</style>", b"<!--", b"-->", b'<div class="ad">', b"</div>", b"<p", b">", b"<", b"x y",
            b"&amp;", b"&", b"<html ", b" lang = 'de'", b" lang=FR", b"</nav\n>", b"<nav>", b"\n", b"<footer", b"=", b"</"]
    for _ in range(3000):
        page = b"".join(rng.choice(bits) for _ in range(rng.randrange(25)))
        assert language.visible(page) == lazy.sub(b" ", page), page
        found = html.search(page)
        assert language.declared_language(page) == (found[1].lower().decode() if found else None), page


@pytest.mark.parametrize("bit", [b"<script ", b"<!--", b"<html ", b"<div class='ad'", b"<", b"&", b"<a <script"])
def test_broken_markup_is_read_once(bit):
    import time

    begin = time.perf_counter()
    language.visible(bit * (2_000_000 // len(bit)))
    language.declared_language(bit * (2_000_000 // len(bit)))
    assert time.perf_counter() - begin < 20


# --- top-k ---

def topk_model(rows, k=10, every=100):
    """Every row is a candidate of every query but itself, also where ids repeat."""
    vectors = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        vectors.append((i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]))
    out = []
    for n, (q, a) in enumerate(vectors):
        if q % every == 0:
            scores = sorted((-min(max(sum(x * y for x, y in zip(a, b)), -(1 << 63)), (1 << 63) - 1), i)
                            for m, (i, b) in enumerate(vectors) if m != n)
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("width, rows", [(16, 3000), (3, 200), (100, 5)])
def test_topk_equals_brute_force(spark, width, rows):
    rng = np.random.default_rng(rows)
    data = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 20)]) for i in range(-rows // 2, rows // 2)]
    data += [(100_000, None), (100_100, []), (100_200, [1.0, None]), (100_300, [float("nan")]), (None, [1.0]),
             (100_400, [0.5] * 25), (200, [0.25] * 20), (200, [0.25] * 20), (1, [2.0] * 20), (1, [-3.0] * 20), (100_500, [float("inf")]), (100_600, [3e38] * 20), (100_700, [-3e38] * 3),
             *[(200_000 + j, data[1][1]) for j in range(30)]]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in data], "vec_id long, embedding array<float>, rank int, score int")
    got = sorted(tuple(r) for r in topk.top_k(df, width=width).collect())
    assert got == topk_model(data)


def test_topk_in_several_query_blocks(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(2)
    data = [(int(i), [float(np.float32(x)) for x in rng.normal(0, 0.2, 8)]) for i in range(0, 900)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    assert sorted(tuple(r) for r in topk.top_k(df).collect()) == topk_model(data)
    assert topk.top_k(df.limit(0)).count() == 0


# --- decontamination ---

def align_model(a, b):
    h = [[0.0] * (len(a) + 1) for _ in range(len(b) + 1)]
    for i in range(1, len(b) + 1):
        for j in range(1, len(a) + 1):
            same = decontaminate.MATCH if a[j - 1] == b[i - 1] else decontaminate.CHANGE
            h[i][j] = max(0, h[i - 1][j - 1] + same, h[i - 1][j] + decontaminate.GAP, h[i][j - 1] + decontaminate.GAP)
    return max(max(r) for r in h)


def test_alignment_equals_the_full_table():
    rng = random.Random(3)
    for _ in range(400):
        a = [rng.randint(0, 4) for _ in range(rng.randint(0, 25))]
        b = [rng.randint(0, 4) for _ in range(rng.randint(0, 20))]
        score, first, end = decontaminate.align(np.array(a, np.uint64), np.array(b, np.uint64))
        assert abs(score - align_model(a, b)) < 1e-9 and abs(align_model(a[first:end], b) - score) < 1e-9


def planted(spark):
    rng = random.Random(11)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "re", "su") for b in ("ban", "dor", "fel", "gin", "hup", "jas")] + ["the", "of"]
    said = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, said(rng.randrange(15, 45))) for i in range(20)] + [(90, ["tiny", "one"]), (91, [])]
    docs, want = [], set()
    for i in range(120):
        words = said(rng.randrange(20, 200))
        if i % 3 == 0:
            item, text = items[rng.randrange(20)]
            copy = [w for w in text if rng.random() > 0.05]
            for k in range(0, len(copy), 9):
                copy[k] = "changed"
            at = rng.randrange(len(words))
            words[at:at] = copy
            want.add((i, item))
        docs.append((i, " ".join(words).title() + "."))
    docs += [(500, None), (501, ""), (None, "Tiny,  ONE!"), (502, "tiny one " * 40_000)]
    want |= {(None, 90), (502, 90)}
    bench = [(i, " ".join(t)) for i, t in items] + [(None, None)]
    return (spark.createDataFrame([(i, t, 1, 2.0) for i, t in docs], "doc_id long, text string, item_id int, score double"),
            spark.createDataFrame(bench, "item_id long, text string"), want)


def test_planted_and_edited_copies_are_found(spark):
    docs, bench, want = planted(spark)
    found = decontaminate.find_leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all(0.4 <= r.score <= 1 and r.first_word < r.end_word for r in found)
    left = decontaminate.drop_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == docs.count() - len({d for d, _ in want})
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0
    assert decontaminate.find_leaks(docs.limit(0), bench).count() == 0


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    docs, bench, want = planted(spark)
    monkeypatch.setattr(decontaminate, "ITEM_BYTES", 700)
    assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()} == want


@pytest.mark.parametrize("step", [2, 3, 4, 5])
def test_evenly_edited_copies_are_found_as_by_the_full_table(spark, step):
    """Every ``step``-th word replaced, or (2) a word put in after each one."""
    rng = random.Random(step)
    items = [[f"w{rng.randrange(300)}" for _ in range(rng.randrange(8, 50))] for _ in range(12)]
    docs, want, copies = [], {}, 0
    for d in range(48):
        words = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(0, 90))]
        item = items[d % 12]
        copy = [w for x in item for w in (x, f"new{rng.randrange(10**9)}")] if step == 2 else [
            f"new{k}" if k % step == step - 1 else w for k, w in enumerate(item)]
        at = rng.randrange(len(words) + 1)
        words[at:at] = copy if d < 36 else item
        docs.append((d, " ".join(words)))
        for i, text in enumerate(items):
            share = align_model(words, text) / len(text)
            if share >= decontaminate.LEAST:
                want[d, i] = share
                copies += d < 36 and i == d % 12
    assert copies == 36
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    found = decontaminate.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), bench).collect()
    assert {(r.doc_id, r.item_id): round(r.score, 9) for r in found} == {k: round(v, 9) for k, v in want.items()}


def test_short_items_need_more_than_a_share(spark):
    """Three words of a question of seven are no copy; items of up to five words must be there whole."""
    bench = spark.createDataFrame([(1, "what is the name of this river"), (2, "one fine day in may"), (3, "big red fox")],
                                  "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "we know what is the reason"), (2, "they ask what is the name of this river today"), (3, "on one fine day in june"),
        (4, "it was one fine day in may"), (5, "a big fox"), (6, "the big red fox"), (7, "what is the name of this lake"),
        (8, "the name of this lake"), (9, "the name of this hill"), (10, "shores of this river")],
        "doc_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {(2, 1), (4, 2), (6, 3), (7, 1)}
    assert {r.doc_id for r in decontaminate.drop_leaks(docs, bench).collect()} == {1, 3, 5, 8, 9, 10}


def test_exact_benchmark_copies_of_the_corpus(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SMALL, "documents").collect()]
    items = [(r.item_id, r.text) for r in read(spark, SMALL, "benchmark").collect()]
    want = {(d, i) for d, t in docs for i, u in items if u in t}
    got = {(r.doc_id, r.item_id) for r in QUERIES["op8_decontaminate"](spark, SMALL).collect()}
    assert want <= got and len(got - want) <= 2


# --- URL rules ---

@pytest.mark.parametrize("url, host, path, rule, verdict", [
    ("http://www.Example.com/en/1?x", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://m.example.com/en/", "m.example.com", "/en/", "example.com/en/", "block"),
    ("https://example.com/en", "example.com", "/en", "com/", "allow"),
    ("x://badexample.com/en/", "badexample.com", "/en/", "com/", "allow"),
    ("http://a.net/es/1", "a.net", "/es/1", "net/es/", "block"),
    ("http://a.net/ES/1", "a.net", "/ES/1", None, "allow"),
    ("http://a.net?q=b.com/", "a.net", "", None, "allow"),
    ("http://com", "com", "", None, "allow"),
    ("http://com/", "com", "/", "com/", "allow"),
    ("http://x.org/wp-login.php?a", "x.org", "/wp-login.php", None, "block"),
    ("http://ad.doubleclick.org/", "ad.doubleclick.org", "/", None, "block"),
    ("http://x.org/a?u=//ad.doubleclick.org/", "x.org", "/a", None, "allow"),
    ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("", "", "", None, "allow"), ("://", "", "", None, "allow"),
    ("http://a.com/" + "p" * 100_000, "a.com", "/" + "p" * 100_000, "com/", "allow"),
])
def test_url_rules(spark, url, host, path, rule, verdict):
    pages = spark.createDataFrame([(1, url, "clash"), (None, url, "clash")], "page_id long, url string, rule string")
    rows = url_rules.judge(pages, LISTED + PATTERNS).collect()
    assert [tuple(r)[2:] for r in rows] == [(host, path, rule, verdict)] * 2


def test_paths_without_a_host_are_judged(spark):
    urls = ["file:///setup.exe", "http:///wp-login.php", "file:///com/", "://", "", None]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    got = {r.page_id: (r.host, r.rule, r.verdict) for r in url_rules.judge(pages, LISTED + PATTERNS).collect()}
    assert got == {0: ("", None, "block"), 1: ("", None, "block")} | {i: ("", None, "allow") for i in (2, 3, 4, 5)}


def test_rules_are_filed_under_their_rarest_token(spark):
    parts = spark.createDataFrame([(["com", "en", ""],), (["com", "example", "en", ""],), (["en"],)], "tokens array<string>")
    index = {r.name: r.token for r in url_rules.rule_index(parts, LISTED + PATTERNS).collect()}
    assert index["com/"] == "com" and index["example.com/en/"] == "example" and index["www.example.com/en/"] == "www"
    assert index["login form"] == "login"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_queries_match_their_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    out = QUERIES[name](spark, SMOKE)
    assert sorted(out.columns) == sorted(columns)
    assert sorted(map(str, map(tuple, out.select(*columns).collect()))) == sorted(map(str, want.fetchall()))


# --- pipeline ---

def test_pipeline_stages_take_effect(spark):
    from test_text_operators import repeats_model, simhash_model
    import ast

    docs = read(spark, SMOKE, "documents")
    kept = corpus_pipeline.drop_toxic(spark, docs, SMOKE)
    scored = {r.doc_id: r.predicted for r in QUERIES["op4_toxicity"](spark, SMOKE).collect()}
    first = {r.doc_id: r.text for r in kept.collect()}
    assert set(first) == {i for i, p in scored.items() if not p} and kept.columns == docs.columns
    groups = [ast.literal_eval(r) for r in simhash_model(list(first.items()))]
    second = {r.doc_id: r.text for r in corpus_pipeline.drop_near_duplicates(spark, kept, SMOKE).collect()}
    assert set(second) == {c for _, _, c in groups}
    rest = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in second.items()], docs.schema)
    cut = {r.doc_id: r for r in corpus_pipeline.cut_repeated_passages(spark, rest, SMOKE).collect()}
    for row in map(ast.literal_eval, repeats_model(list(second.items()))):
        doc, _, removed, text = row
        assert cut[doc].text == (text if removed else second[doc]) and cut[doc].n_chars == len(cut[doc].text)
    out = corpus_pipeline.run(spark, SMOKE).collect()
    assert {r.doc_id for r in out} <= set(second) and len(out) >= len(second) - 10
    assert all(r.n_tokens == len(r.token_ids) for r in out)


def test_pipeline_edge_rows(spark):
    rows = [(None, None, None, None, None, 1), (1, "", "en", "s", 0, 2), (2, "some plain words " * 40, "en", None, 5, 3),
            (2, "some plain words " * 40, "en", None, 5, 3), (3, "\x00 odd \u2028 text", None, "s", None, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMOKE)
        assert out.columns == docs.columns, name
        assert stage(spark, docs.limit(0), SMOKE).count() == 0
        assert {r.doc_id for r in out.collect()} >= {2, 3}
    assert corpus_pipeline.encode_tokens(spark, docs, SMOKE).filter(F.size("token_ids") == 0).count() == 2
