"""Tokenizer alignment, centroid clustering and source mixing, held against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import alignment, centroids, mixing
from quarry.llm.queries import QUERIES, read, tokenizer_path

SMOKE = "/root/testdata/sf0.001"
A_PATH, B_PATH = tokenizer_path(), tokenizer_path("piece_bpe_32k.model")


# --- alignment ---

def alignment_model(docs):
    """Rows by plain byte bookkeeping: every token's bytes, every pair of tokens."""
    import sentencepiece
    from tokenizers import Tokenizer

    from quarry.llm.bpe import byte_chars

    a, b, chars = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH), byte_chars()
    a.encode_special_tokens = True
    done, held = [], Counter()
    for doc, text in docs:
        groups = []
        if text:
            want = (" " + text).encode()
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            parts_a = [bytes(chars[c] for c in a.id_to_token(i)) for i in ids_a]
            parts_b = [bytes([int(b.id_to_piece(i)[1:-1], 16)]) if b.is_byte(i) else
                       b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
            if b"".join(parts_a) == want == b"".join(parts_b):
                ends = [np.cumsum([len(p) for p in parts]).tolist() for parts in (parts_a, parts_b)]
                at = [0, 0]
                for cut in sorted(set(ends[0]) & set(ends[1])):
                    to = [es.index(cut, i) + 1 for es, i in zip(ends, at)]
                    groups.append([ids[i:j] for ids, i, j in zip((ids_a, ids_b), at, to)])
                    at = to
        links = Counter((x, y) for g, h in groups for x in g for y in h)
        held.update(links.keys())
        done.append((doc, groups, links))
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    return sorted((str((
        doc, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), sum(links.values()),
        sum(n for (x, y), n in links.items() if held[x, y] == most[x]), sum(n * held[p] for p, n in links.items()),
        hashlib.sha256(";".join("|".join(",".join(map(str, s)) for s in g) for g in groups).encode()).hexdigest()
        if groups else "")) for doc, groups, links in done))


ODD_TEXTS = [None, "", " ", "  ", "a", " a", "naïve café", "日本語 テキスト", "x😀y 👩‍👩‍👧 z", "a▁b", "<|endoftext|> <s> <0x41>", "tab\tline\n\n end ",
             "\x00 odd   text", "ａ① é", "  double  spaces   run" + " " * 70, "ᚠᛇᚻ ქართული \U0001F9FF", "I'm we'll 1234567 !!!??",
             "same words same words", "same words same words", "​ ﻿x", "́", "🏳️‍🌈" * 3, "a \u00a0 b\u3000c d\u2028e", "x ▁y z", "end ", " \n lead", "it 's a 'll", "ß \u0085 x", "a b ▁", "é é \x85"]


def test_alignment_equals_bookkeeping(spark):
    rng = random.Random(3)
    alphabet = "ab cdé  日😀\t\n'1▂ßñ,.́"
    docs = list(enumerate(ODD_TEXTS)) + [(100 + i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(80)))) for i in range(80)]
    docs += [(None, "same words"), (3, "again"), (3, "again"), (500, "plain words and numbers 12 " * 9000)]
    table = spark.createDataFrame([(i, t, 7, "x") for i, t in docs], "doc_id long, text string, n_a int, chunk string").repartition(3)
    got = alignment.align(table, A_PATH, B_PATH)
    assert sorted(str(tuple(r)) for r in got.collect()) == alignment_model(docs)
    assert alignment.align(table.limit(0), A_PATH, B_PATH).count() == 0


def test_alignment_of_the_table(spark):
    docs = [(r.doc_id, r.text) for r in read(spark, SMOKE, "documents").collect()]
    assert sorted(str(tuple(r)) for r in QUERIES["op11_alignment"](spark, SMOKE).collect()) == alignment_model(docs)


def known_atoms():
    a, b = (k(open(p, "rb").read()) for k, p in ((alignment.ByteLevel, A_PATH), (alignment.Pieces, B_PATH)))
    return alignment.Atoms(a, b, alignment._id_texts(len(a.bytes), len(b.bytes)))


def test_atoms_encode_as_the_whole():
    known = known_atoms()
    assert known.b.cuttable
    raw = ("Some words, 日本 and  spaces\n" * 50 + "x" * 300 + " y" * 90 + " ß é  end ").encode()
    known.b.cuttable = False
    whole, = alignment.aligned([raw], known)
    known.b.cuttable = True
    assert len(list(alignment.parts(raw, 40))) >= 30
    for size in (40, 1 << 20):
        cut, = alignment.aligned([raw], known, size)
        assert whole.digest == cut.digest and whole.counts == cut.counts
        assert whole.pairs.tolist() == cut.pairs.tolist() and whole.times.tolist() == cut.times.tolist()


def test_large_groups_count_ids_first(monkeypatch):
    def counted(limit):
        monkeypatch.setattr(alignment, "GROUP_LINKS", limit)
        known = known_atoms()
        known._add([b"abc", b"de"], np.array([4, 7]), np.array([1, 2, 1, 1, 3]), np.array([4, 4, 2]),
                   np.array([1, 2, 3, 4, 7]), np.array([2, 4, 7]))
        out, = alignment.aligned([b"abc de"], known)
        return out.pairs.tolist(), out.times.tolist(), out.counts
    assert counted(0) == counted(100) and counted(0)[2] == (5, 3, 3, 2 + 2 + 1)


def test_the_memo_is_bounded(spark, monkeypatch):
    docs = [(i, f"word{i} and {i} others") for i in range(600)]
    table = spark.createDataFrame(docs, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(alignment, "KNOWN_ATOMS", 100)
    assert sorted(str(tuple(r)) for r in alignment.align(table, A_PATH, B_PATH).collect()) == alignment_model(docs)


# --- centroids ---

def centroid_model(rows, k=40, rounds=5, dims=64, scale=256):
    kept = [(i, [int(np.floor(float(x) * scale)) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and np.isfinite(x) for x in v)]
    starts = sorted((hashlib.sha256(f"2:{i}".encode()).hexdigest(), v) for i, v in kept if i is not None)[:k]
    now = [v for _, v in starts]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(now))
    for _ in range(rounds):
        own = defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        now = [[sum(x) // len(own[n]) for x in zip(*own[n])] if n in own else c for n, c in enumerate(now)]
    found = [(i, *nearest(v)) for i, v in kept] if now else []
    inertia = Counter()
    for _, d, c in found:
        inertia[c] += d
    top = (1 << 63) - 1
    return sorted(str((i, c, min(d, top), min(inertia[c], top), min(sum(inertia.values()), top),
                       hashlib.sha256(",".join(map(str, now[c])).encode()).hexdigest())) for i, d, c in found)


def vectors_frame(spark, rows):
    return spark.createDataFrame([(i, v, 5, "x") for i, v in rows],
                                 "vec_id long, embedding array<double>, cluster int, d string").repartition(3)


@pytest.mark.parametrize("spread", [1.0, 1e7, 1e18, 1e36])
def test_clustering_equals_brute_force(spark, spread):
    rng = random.Random(5)
    rows = [(i, [rng.gauss(i % 7, 1) * spread for _ in range(64)]) for i in range(150)]
    rows += [(3, rows[3][1]), (3, rows[9][1]), (None, rows[4][1]), (201, None), (202, [1.0] * 63), (203, [None] + [1.0] * 63),
             (204, [float("nan")] * 64), (205, [float("inf")] * 64), (-6, [-0.5] * 64), (-7, [-0.5] * 64)]
    got = centroids.cluster(vectors_frame(spark, rows))
    assert got.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(str(tuple(r)) for r in got.collect()) == centroid_model(rows)


def test_clustering_of_few_equal_or_no_vectors(spark):
    few = [(i, [float(i // 2)] * 64) for i in range(6)]
    assert sorted(str(tuple(r)) for r in centroids.cluster(vectors_frame(spark, few)).collect()) == centroid_model(few)
    assert centroids.cluster(vectors_frame(spark, few).limit(0)).count() == 0
    assert centroids.cluster(vectors_frame(spark, [(None, [1.0] * 64)])).count() == 0


def test_pivots_save_distances():
    rng = np.random.default_rng(2)
    marks = rng.integers(-9000, 9000, (40, 64)).astype(object)
    rows = (marks.astype(float)[rng.integers(0, 40, 500)] + rng.integers(-50, 50, (500, 64)))
    pivots = centroids.pick_pivots(marks, 8)
    matrix, fixed = centroids.alike(rows, marks)
    table = centroids.distances(*centroids.alike(rows, pivots))
    own, best, computed = centroids.nearest(matrix, table, fixed, centroids.distances(marks, pivots))
    every = ((matrix[:, None, :] - fixed[None]) ** 2).sum(axis=2)
    assert (own == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert computed < 0.2 * every.size


# --- mixing ---

def mixing_model(sizes, weights=(3, 1, 2)):
    """Targets by resharing the excess until no source is above twice its size (as fractions)."""
    from fractions import Fraction

    names = sorted((s for s in sizes if s is not None), key=str.encode) + [None] * (None in sizes)
    weight = {s: Fraction(weights[i % 3]) for i, s in enumerate(names)}
    left, capped = Fraction(3, 2) * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        whole = sum(weight[s] for s in free)
        target = {s: Fraction(2 * sizes[s]) if s in capped else
                  (left - sum(2 * sizes[c] for c in capped)) * weight[s] / whole for s in names}
        over = {s for s in free if target[s] >= 2 * sizes[s]}
        if not over:
            return {s: float(t) for s, t in target.items()}
        capped |= over


@pytest.mark.parametrize("seed", range(4))
def test_targets_equal_resharing(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice(["a", "é", "B", "源", "\U0001F600", "z", "", "￮"]) + str(i): int(10 ** rng.uniform(0, 6)) for i in range(30)}
    sizes |= {None: 50, "none": 0, "same1": 7, "same2": 7}
    got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long").repartition(5))
    rows = {r.source: r for r in got.collect()}
    want = mixing_model(sizes)
    assert set(rows) == set(want) and all(r.source_size == sizes[s] for s, r in rows.items())
    assert all(abs(rows[s].target - t) <= 1e-12 * t for s, t in want.items())
    assert abs(sum(r.target for r in rows.values()) - 1.5 * sum(sizes.values())) < 1e-6 * sum(sizes.values())


def test_mix_emits_what_was_planned(spark):
    rows = [(i, "w " * (i % 17), f"s{i % 4}", 9, "c") for i in range(4000)]
    rows += [(None, "null id", None, 1, "c"), (1, None, "s1", 1, "c"), (2, "", "s2", 1, "c"), (5, " one word\x0b two", "s1", 1, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size int, copy string").repartition(4)
    plan = mixing.planned(docs)
    seen = plan.select("doc.*", F.col("size").alias("n"), "source_size", "target", "rate", "copies").collect()
    assert len(seen) == len(rows) and {r.n for r in seen if r.doc_id == 5 and r.text[0] == " "} == {2}
    assert all(r.copies in (int(r.rate), int(r.rate) + 1) and r.copies <= 2 for r in seen)
    for source in {r.source for r in seen}:
        own = [r for r in seen if r.source == source]
        assert sum(r.n for r in own) == own[0].source_size
        if len(own) > 100:
            assert abs(sum(r.n * r.copies for r in own) - own[0].target) < 0.1 * own[0].source_size
    out = mixing.mix(docs)
    assert out.columns == ["doc_id", "text", "source", "size", "copy"]
    made = Counter((r.doc_id, r.text, r.source) for r in out.collect())
    planned = Counter()
    for r in seen:
        planned[r.doc_id, r.text, r.source] += r.copies
    assert made == +planned
    assert sorted(map(str, mixing.mix(docs.repartition(7)).collect())) == sorted(map(str, out.collect()))
    assert mixing.planned(docs.limit(0)).count() == 0 and mixing.mix(docs.limit(0)).count() == 0
    empty = docs.filter("doc_id = 2 AND text = ''")
    assert [r.copies * r.size for r in mixing.planned(empty).collect()] == [0]


def test_mixing_without_a_broadcast(spark, monkeypatch):
    want = sorted(map(str, QUERIES["op13_mixing"](spark, SMOKE).collect()))
    monkeypatch.setattr(mixing, "BROADCAST_BYTES", 0)
    assert sorted(map(str, QUERIES["op13_mixing"](spark, SMOKE).collect())) == want


def test_mixing_stays_in_the_jvm(spark):
    plan = QUERIES["op13_mixing"](spark, SMOKE)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan and "InArrow" not in plan
