"""Licence scan, SimHash, BPE and substring dedup against plain brute-force versions."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash

from quarry.llm import bpe, licenses, simhash, substrings
from quarry.llm.automaton import SuffixAutomaton
from quarry.llm.components import components
from quarry.llm.lexicon import Lexicon, compile_lexicon
from quarry.llm.queries import QUERIES, read, tokenizer_path

SMOKE = "/root/testdata/sf0.001"
EDGES = "doc_id long, text string, fp string, kept string, score double, rank int"


def edge_docs(spark, texts):
    """Rows with extra columns whose names clash with the operators' own."""
    return spark.createDataFrame([(i, t, "x", "y", 1.5, 2) for i, t in texts], EDGES)


# --- licences ---

def licence_model(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    starts, labels = [], set()
    for phrase, label in (("the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        for i in range(len(words)):
            if words[i:i + len(p)] == p:
                starts.append(i)
                labels.add(label)
    return (len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels)))


def test_license_scan_equals_plain_search(spark):
    rows = read(spark, SMOKE, "documents").select("doc_id", "text").collect()
    want = {r.doc_id: licence_model(r.text) for r in rows}
    got = {r.doc_id: tuple(r)[1:6] for r in QUERIES["op2_license_scan"](spark, SMOKE).collect()}
    assert got == want and sum(w[1] for w in want.values()) > 0


def test_license_edge_cases(spark):
    texts = [(1, None), (2, ""), (None, "The MIT License the mit license"), (3, "CC-BY-NC\tcc by nc." * 3),
             (3, "Ünder THE  mit-LICENSE é the mit licenseé"), (4, "x" * 300_000 + " the mit license"),
             (5, "the mit license\x85apache license, version 2")]
    out = licenses.scan_licenses(edge_docs(spark, texts)).collect()
    assert sorted(str(tuple(r)[:6]) for r in out) == sorted(str((i, *licence_model(t))) for i, t in texts)
    assert all(0 <= r.score <= 1 for r in out)
    assert licenses.scan_licenses(edge_docs(spark, [])).count() == 0


@pytest.mark.parametrize("text, labels, permissive", [
    ("MIT", {"mit"}, True),
    ("MIT OR GPL-3.0-only", {"mit", "gpl-3"}, True),
    ("MIT AND GPL-3.0-only", {"mit", "gpl-3"}, False),
    ("GPL-3.0-only OR MIT AND Apache-2.0", {"gpl-3", "mit", "apache-2"}, True),
    ("(GPL-3.0-only OR MIT) AND AGPL-3.0", {"gpl-3", "mit", "agpl-3"}, False),
    ("GPL-2.0-only WITH Classpath-exception-2.0", {"gpl-2"}, True),
    ("GPL-2.0-only WITH some-exception OR ISC", {"gpl-2", "isc"}, True),
    ("MIT AND", {"mit"}, True),
    ("MIT and Own-1.0 */", {"mit", "own-1.0"}, False),
])
def test_license_expressions(text, labels, permissive):
    value = licenses.evaluate(text)
    assert (value.labels, value.permissive) == (labels, permissive)


@pytest.mark.parametrize("text, labels, permissive, n", [
    ("SPDX-License-Identifier: MIT\nand more", "mit", True, 1),
    ("SPDX License Identifier: MIT", "mit", True, 1),
    ("spdx-license-identifier : Apache-2.0", "apache-2", True, 1),
    ("# SPDX-License-Identifier:\n#   GPL-3.0-only", "gpl-3", False, 1),
    ("SPDX-License-Identifier: (MIT OR\n Apache-2.0) rest", "apache-2,mit", True, 1),
    ("SPDX-License-Identifier: GPL-2.0-only WITH\n Classpath-exception-2.0", "gpl-2", True, 1),
    ("SPDX-License-Identifier: MIT and\nSPDX-License-Identifier: GPL-3.0", "gpl-3,mit", False, 2),
    ("é SPDX-License-Identifier: ISC é SPDX-License-Identifier: CC0-1.0", "cc0,isc", True, 2),
    ("SPDX-License-Identifier", "", None, 0), ("SPDX-License-Identifier: \n\n", "", None, 0)])
def test_tags_of_the_automaton(text, labels, permissive, n):
    found = licenses.Scanner().scan(text.encode())
    assert (found[5], found[7], found[8]) == (labels, permissive, n)


def test_no_license_expression():
    assert licenses.evaluate("") is None and licenses.evaluate("*/") is None


# --- SimHash ---

def fingerprint_model(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0d]+", text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_model(rows):
    fps = [fingerprint_model(t) for _, t in rows]
    group = list(range(len(rows)))

    def top(i):
        while group[i] != i:
            i = group[i]
        return i
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                group[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(str((doc, f"{fps[i]:016x}", least.get(top(i)))) for i, (doc, _) in enumerate(rows))


def near_copies(rng, n):
    base = [[f"w{rng.randrange(500)}" for _ in range(rng.randrange(60, 200))] for _ in range(8)]
    rows = []
    for i in range(n):
        words = list(rng.choice(base))
        for _ in range(rng.randrange(3)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(9)}"
        rows.append((i, " ".join(words)))
    return rows


def test_simhash_equals_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in read(spark, SMOKE, "documents").select("doc_id", "text").collect()]
    got = sorted(str(tuple(r)) for r in QUERIES["op3_simhash"](spark, SMOKE).collect())
    assert got == simhash_model(rows)


def test_simhash_edge_cases(spark):
    rows = near_copies(random.Random(4), 60) + [(100, None), (101, ""), (102, " \n"), (None, "a b"), (None, None), (103, "A B"),
                                                (104, "one two three four"), (104, "one two three four"), (7, "zz")]
    got = sorted(str(tuple(r)) for r in simhash.near_duplicates(edge_docs(spark, rows)).collect())
    assert got == simhash_model(rows)
    assert simhash.near_duplicates(edge_docs(spark, [])).count() == 0
    for text, n in (("x " * 400_000, 1), ("abc", 1)):
        assert simhash.fingerprint(text.encode()) == fingerprint_model(text)


def test_simhash_tiles_lose_no_component(spark):
    rng = random.Random(9)
    seeds = [rng.getrandbits(64) for _ in range(5)]
    values = {s ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for s in seeds for _ in range(120)}
    values = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in values], "fp long")
    want = {}
    for v, root in simhash.forest(values):
        want[v] = root
    roots = components(simhash.links(fps, tile=16))
    got = {r.node: r.root for r in roots.collect()}
    assert {v: got.get(v, v) for v in values} == {v: want.get(v, v) for v in values}


def test_block_masks_hold_the_pigeonhole():
    rng = random.Random(2)
    masks = simhash.block_masks()
    for _ in range(500):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), 4):
            y ^= 1 << b
        assert any((x ^ y) & m & 0xFFFFFFFFFFFFFFFF == 0 for m in masks)


def test_keep_one_of_each_group(spark):
    rows = near_copies(random.Random(6), 40) + [(None, "a b c"), (None, "a b c"), (3, "a b c"), (3, "a b c"), (50, None), (51, "")]
    out = [(r.doc_id, r.text) for r in simhash.keep_one(edge_docs(spark, rows)).collect()]
    classes = {r.doc_id: r.component_id for r in simhash.near_duplicates(edge_docs(spark, rows)).collect() if r.doc_id is not None}
    assert sorted(i for i, _ in out) == sorted({*classes.values()} | {3}) or (3, "a b c") in out
    assert len(out) == len({c for c in classes.values()}) + (0 if classes[3] == 3 and rows[3][1] == "a b c" else 1)
    assert out.count((3, "a b c")) == 1


# --- BPE ---

def test_bpe_equals_the_tokenizers_library(spark):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(tokenizer_path())
    want = {}
    for r in read(spark, SMOKE, "documents").collect():
        ids = known.encode(r.text or "", add_special_tokens=False).ids
        want[r.doc_id] = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                          hashlib.sha256(known.decode(ids, skip_special_tokens=False).encode()).hexdigest())
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op5_bpe"](spark, SMOKE).collect()}
    assert got == want


def odd_texts():
    rng = random.Random(1)
    alphabet = " \n\t  a'sbtreZ0١é漢 \u00a0\x85\x1c\x0b,.\u200b\u3000\U0001F600ǅ²̀"
    made = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(40))) for _ in range(400)]
    return [None, "", " ", "  ", "<|endoftext|>", "a <|endoftext|><|endoftext|> b", "x" * 5000, "ab" * 3000 + " c",
            "the " * 300_000, *made]


def test_bpe_edge_cases(spark):
    from tokenizers import Tokenizer

    known = Tokenizer.from_file(tokenizer_path())
    texts = odd_texts()
    docs = edge_docs(spark, [(i if i % 7 else None, t) for i, t in enumerate(texts)])
    got = sorted((r.token_ids, r.decoded) for r in bpe.encode(docs, tokenizer_path(), most=50).collect())
    assert got == sorted((known.encode(t or "", add_special_tokens=False).ids, t or "") for t in texts)
    assert bpe.encode(edge_docs(spark, []), tokenizer_path()).count() == 0


def test_word_counts_cover_all_texts(spark):
    texts = [t for t in odd_texts() if t and "endoftext" not in t][:40]
    want = {}
    for t in texts:
        for w in bpe._WORDS.findall(t):
            want[w] = want.get(w, 0) + 1
    counts = {r.word: r.n for r in bpe.word_counts(edge_docs(spark, list(enumerate(texts)))).collect()}
    assert counts == want


def test_lexicon_is_minimal_and_exact():
    words = {f"{a}{b}ing".encode(): [i, j] for i, a in enumerate("bdfgklmnprst") for j, b in enumerate("aeiou")}
    lexicon = Lexicon(compile_lexicon(words))
    assert len(lexicon.finals) == 6  # one state for each of: start, after a, after b, i, n, g
    numbers = lexicon.lookup([*words, b"", b"ba", b"bain", b"bainge", b"xaing"])
    assert [np.frombuffer(lexicon.token_bytes(n), np.int32).tolist() for n in numbers[:len(words)]] == list(words.values())
    assert numbers[len(words):].tolist() == [-1] * 5
    assert Lexicon(compile_lexicon({})).lookup([b"a", b""]).tolist() == [-1, -1]


# --- substring dedup ---

def repeats_model(rows, window=20):
    words = [(t or "").encode().split() for _, t in rows]
    places = {}
    for i, w in enumerate(words):
        for s in range(len(w) - window + 1):
            places.setdefault(tuple(w[s:s + window]), []).append((i, s))
    out = []
    for i, (doc, _) in enumerate(rows):
        gone = set()
        for s in range(len(words[i]) - window + 1):
            for j, u in places[tuple(words[i][s:s + window])]:
                if (j == i and u < s) or (doc is not None and rows[j][0] is not None and rows[j][0] < doc):
                    gone.update(range(s, s + window))
        kept = b" ".join(w for k, w in enumerate(words[i]) if k not in gone).decode()
        out.append(str((doc, len(words[i]), len(gone), kept)))
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_substring_dedup_equals_all_windows(spark, seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randrange(10, 60))] for _ in range(12)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(6)):
            part = list(rng.choice(passages))
            if rng.random() < 0.5:
                part[rng.randrange(len(part))] = rng.choice(vocabulary)
            words += part if rng.random() < 0.7 else [rng.choice(vocabulary) for _ in range(rng.randrange(40))]
        rows.append((rng.choice([i, i, i, None, i // 2]), rng.choice([" ", "\n", "  "]).join(words)))
    rows += [(5, None), (6, ""), rows[3], rows[9], (None, rows[9][1])]
    got = substrings.remove_repeats(edge_docs(spark, rows)).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(str(tuple(r)) for r in got) == repeats_model(rows)


def test_substring_dedup_of_long_and_empty_tables(spark):
    assert substrings.remove_repeats(edge_docs(spark, [])).count() == 0
    rng = random.Random(3)
    long = " ".join(f"u{rng.randrange(9999)}" for _ in range(45_000))  # more than one automaton's words
    rows = [(1, long), (2, "start " + long), (3, "the same word " * 30)]
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substrings.remove_repeats(edge_docs(spark, rows)).collect()}
    assert got[1] == (45_000, 0, long) and got[2] == (45_001, 45_000, "start")
    assert got[3] == (90, 87, "the same word")  # every window but the first three stands earlier


def test_cut_repeats_leaves_other_columns(spark):
    docs = edge_docs(spark, [(1, "a b " * 12), (2, "x  y"), (None, None)])
    out = {r.doc_id: r for r in substrings.cut_repeats(docs).collect()}
    assert out[2].text == "x  y" and out[None].text is None and out[1].kept == "y"
    assert out[1].text == "a b"


def test_automaton_finds_first_ends():
    rng = random.Random(5)
    for _ in range(500):
        k = rng.randint(1, 3)
        seqs = [[rng.randint(0, k) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(1, 4))]
        automaton, firsts, base, w = SuffixAutomaton(), {}, 0, rng.randint(1, 5)
        for s in seqs:
            automaton.add(s)
            for i in range(len(s) - w + 1):
                firsts.setdefault(tuple(s[i:i + w]), base + i + w - 1)
            base += len(s)
        q = [rng.randint(0, k) for _ in range(rng.randint(0, 15))]
        want = [firsts.get(tuple(q[i - w + 1:i + 1]), -1) if i >= w - 1 else -1 for i in range(len(q))]
        assert automaton.first_ends(q, w) == want


def test_word_hashes_depend_on_bytes_alone():
    from quarry.llm.common import NOT_SPACE
    from quarry.llm.wordhash import hashed_words, text_pieces

    h = hashed_words(b"aa b  aa \n b c" * 3, NOT_SPACE)[0]
    assert h[0] == h[2] and h[1] == h[3] and len(set(h.tolist())) == 4
    text = b"word " * 1000
    assert b"".join(p.tobytes() for _, p in text_pieces(text, NOT_SPACE, 64)) == text
    assert np.unique(hashed_words(text, NOT_SPACE)[0]).size == 1
