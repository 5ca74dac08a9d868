"""Findings of round 3 on the training-data operators."""

import pickle
import random
import re
import sys
import tracemalloc

import numpy as np
import pyarrow as pa

from quarry.llm import bpe, simhash, substrings, toxicity
from quarry.llm.lexicon import Lexicon, compile_lexicon
from quarry.llm.queries import QUERIES, tokenizer_path


def test_f1_base_phrases_are_the_contracts(spark, tmp_dir):
    """"the mit license" is a base phrase only behind "under"."""
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}
    texts = ["Released UNDER the MIT-License.", "see the MIT license", "under the mit license under\nthe mit license, cc by nc 4",
             "asunder the mit license", "the mit license; under the mit licenses", "Apache License, Version 2 the MIT license", "", None]

    def model(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        hits = [(i, label) for p, label in phrases.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
        starts = [i for i, _ in hits]
        return (len(words), len(hits), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in hits})))

    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_dir}/documents.parquet")
    got = {r.doc_id: tuple(r)[1:6] for r in QUERIES["op2_license_scan"](spark, tmp_dir).collect()}
    assert got == {i: model(t) for i, t in enumerate(texts)}


def test_toxicity_lookups_and_index_size():
    """Hashes that share their first bits are told apart, as by a sorted search; an index holds its
    common weights once, in single precision, and finds the same examples as plain products."""
    rng = np.random.default_rng(3)
    crowded = np.uint64(7) << np.uint64(60) | rng.integers(0, 1 << 20, 300, dtype=np.uint64)
    hashes = np.unique(np.concatenate([crowded, rng.integers(0, 1 << 63, 500, dtype=np.uint64), np.array([2**64 - 1], np.uint64)]))
    asked = np.concatenate([hashes[::3], hashes[:50] + np.uint64(1), rng.integers(0, 1 << 63, 400, dtype=np.uint64)])
    at, features = toxicity.Vocabulary(hashes).places(asked)
    assert sorted(zip(at.tolist(), features.tolist())) == [
        (i, int(np.searchsorted(hashes, h))) for i, h in enumerate(asked) if h in set(hashes.tolist())]
    assert [len(x) for x in toxicity.Vocabulary(hashes[:0]).places(asked)] == [0, 0]

    dense = rng.random((600, 90)) * (rng.random((600, 90)) < np.linspace(0.01, 0.6, 90))
    dense /= np.maximum(np.sqrt((dense ** 2).sum(axis=1, keepdims=True)), 1e-9)
    vectors = [(np.flatnonzero(v).astype(np.int32), v[v > 0]) for v in dense]
    index = toxicity.BlockMaxIndex(vectors, 90, block=64)
    common = int((index.column >= 0).sum())
    assert 0 < common < 90 and index.rough.nbytes == common * 640 * 4
    held = sum(x.nbytes for x in vars(index).values() if isinstance(x, np.ndarray) and x.ndim == 2)
    assert held < 1.1 * index.rough.nbytes  # no second matrix of the same weights
    for query, near in zip(vectors[:40], index.search_all(vectors[:40], 9)):
        want = np.sort(dense[:, query[0]] @ query[1])[::-1][:9]
        assert np.allclose([c for c, _ in near], want[want > 0], atol=1e-13)


def test_shard_matching_works_on_whole_shards():
    """One shard's spans and open windows are those of all comparisons, and apart from the walks in
    the automaton no step is done word by word in Python."""
    rng = random.Random(8)
    w = 20
    passages = [[f"w{rng.randrange(900)}" for _ in range(300)] for _ in range(6)]
    texts = []
    for doc in range(40):
        words = [*rng.choice(passages), *[f"u{rng.randrange(9)}" for _ in range(rng.randrange(60))], *rng.choice(passages)]
        texts.append((doc, 5, words))
    rows = [{"reference": ref, "doc": d, "version": v, "first": 0 if d % 3 else d, "lo": 0, "hi": len(t), "start": 2,
             "words": " ".join(t)} for d, v, t in texts for ref in ((True, False) if d < 12 else (False,))]
    table = pa.Table.from_pylist(rows, pa.schema([("reference", pa.bool_()), *[(c, pa.int64()) for c in ("doc", "version", "first")],
                                                  *[(c, pa.int32()) for c in ("lo", "hi", "start")], ("words", pa.string())]))
    steps = 0

    def count(frame, event, _):
        nonlocal steps
        steps += "call" in event and frame.f_code.co_filename == substrings.__file__

    before = sys.getprofile()
    sys.setprofile(count)
    try:
        out = substrings.match_shard(table, w, True, 0).to_pylist()
    finally:
        sys.setprofile(before)
    assert steps < sum(len(t) for _, _, t in texts) / 4

    first = {}
    for doc, _, t in texts[:12]:
        for i in range(len(t) - w + 1):
            first.setdefault(tuple(t[i:i + w]), (doc, i))
    gone, asked = set(), set()
    for doc, _, t in texts:
        for i in range(len(t) - w + 1):
            found = first.get(tuple(t[i:i + w]))
            if found and found < (doc, i):
                gone |= {(doc, k + 2) for k in range(i, i + w)}
            elif not found or found[0] != doc or doc % 3:
                asked.add((doc, i + 2))
    spans = [r for r in out if r["hash"] is None]
    assert {(r["doc"], k) for r in spans for k in range(r["start"], r["stop"])} == gone
    assert all(a["doc"] != b["doc"] or a["stop"] < b["start"] for a, b in zip(spans, spans[1:]))
    assert {(r["doc"], r["start"]) for r in out if r["stop"] is None} == asked and asked and gone


def test_bpe_worker_holds_little():
    """A worker gets the vocabulary as arrays, without the dictionary that the driver may have made
    for long words, and keeps little while it encodes many different words."""
    with open(tokenizer_path(), encoding="utf-8") as f:
        vocabulary = bpe.Vocabulary(f.read())
    long = [b"abcdefgh" * 40]
    whole = vocabulary.merge(long)
    rng = random.Random(2)
    texts = [" ".join(f"{rng.getrandbits(40):x}" for _ in range(500)) for _ in range(700)]
    batch = pa.RecordBatch.from_pydict({"text": texts})
    lexicon = Lexicon(compile_lexicon({}))
    sent = pickle.dumps(vocabulary)
    tracemalloc.start()
    try:
        encoder, out = bpe.Encoder(pickle.loads(sent), lexicon), []
        held = tracemalloc.get_traced_memory()[0]
        for _, part in bpe.blocks([batch], "text", bpe.ENCODE_BYTES):
            ids, bounds = encoder.encode(part)
            out += encoder.decode(ids, bounds).to_pylist()
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert out == texts and held < 3e6 and peak < 80e6
    assert encoder.vocabulary.merge(long) == whole


def test_broadcasts_are_small_and_counted_as_they_are(spark, monkeypatch):
    """Pipeline: what substring dedup broadcasts takes a third of nested rows, what it and SimHash
    broadcast is no larger than counted before, and rows are the same by a shuffle."""
    rng = random.Random(5)
    passages = [[f"p{i}w{j}" for j in range(24)] for i in range(40)]
    rows = [(i, " ".join(w for p in rng.sample(passages, 8) for w in [*p, *(f"d{i}x{rng.random()}" for _ in range(30))]))
            for i in range(60)]
    docs = spark.createDataFrame([*rows, (60, None), (61, "short"), (None, rows[3][1])], "doc_id long, text string")
    sent, mark = [], substrings.F.broadcast

    def spy(df):
        plan = df._jdf.queryExecution().executedPlan()
        arrays = [c for c, kind in df.dtypes if kind.startswith("array")]
        sizes = [sum(len(r[0]) for r in df.select(c).collect()) for c in arrays]
        sent.append((sum(r.getSizeInBytes() for r in plan.executeCollect()), df.count(), sizes))
        return mark(df)

    monkeypatch.setattr(substrings.F, "broadcast", spy)
    kept = ("doc_id", "n_words", "n_removed", "kept")
    by_broadcast = sorted(map(repr, substrings.remove_repeats(docs).select(*kept).collect()))
    large = [x for x in sent if x[2]]
    parts, spans = [x for x in large if len(x[2]) == 2], [x for x in large if len(x[2]) == 1]
    assert parts and len(spans) == 1 and len(parts) + len(spans) == len(large)
    for size, n, (stretches, numbers) in parts:
        assert numbers == 4 * stretches and size <= n * substrings.PART_ROW + stretches * substrings.PART
    size, n, (numbers,) = spans[0]
    assert numbers >= 2 * 8 * 40 and size + 40 * n <= n * substrings.SPAN_ROW + numbers * substrings.NUMBER
    monkeypatch.setattr(substrings, "BROADCAST_BYTES", 0)
    sent.clear()
    assert sorted(map(repr, substrings.remove_repeats(docs).select(*kept).collect())) == by_broadcast
    assert not [x for x in sent if x[2]]

    counted = []
    monkeypatch.setattr(simhash, "hinted", lambda df, row_bytes, *limit: counted.append((df, row_bytes)) or df)
    assert simhash.keep_one(docs).count() >= 60
    (df, row_bytes), = counted
    largest = max(r.getSizeInBytes() for r in df._jdf.queryExecution().executedPlan().executeCollect())
    assert row_bytes >= 2 * largest  # the row, its key and its places in the hash table
