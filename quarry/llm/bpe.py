"""Byte-level BPE encoding and decoding with a transducer lexicon of the corpus' frequent words.

A text is cut where no token can span: before a space that a non-space follows. The pieces split
into words by the tokenizer's pattern; words of the lexicon get their ids from the automaton, all
others are merged exactly.
"""

from __future__ import annotations

import heapq
import json
from array import array
from collections import Counter
from functools import cached_property
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import byte_class, checkpointed, column_type, map_arrow, slices
from quarry.llm.lexicon import Lexicon, compile_lexicon

#: The word pattern of byte-level BPE vocabularies (a fixed value).
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Words in the lexicon at most, and results that a task remembers at most.
LEXICON_WORDS, MEMO_PIECES = 1 << 18, 40_000
#: Bytes of texts that are counted and encoded at a time, and characters of a piece or word that is remembered.
BLOCK_BYTES, ENCODE_BYTES, _SHORT = 2 << 20, 1 << 20, 64


def byte_chars() -> dict[str, int]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for
    themselves, the others in order from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Vocabulary:
    """Merges, id <-> bytes and special tokens of a byte-level BPE tokenizer file (JSON text). Read
    once and sent as arrays, so that a worker needs neither the file's text nor what it parses to."""

    def __init__(self, source: str) -> None:
        spec = json.loads(source)
        chars = byte_chars()
        ids = spec["model"]["vocab"]
        as_bytes = lambda token: bytes(chars[c] for c in token)
        pieces = {i: as_bytes(t) for t, i in ids.items()}
        self.bytes_id = [0] * 256
        for i, piece in pieces.items():
            if len(piece) == 1:
                self.bytes_id[piece[0]] = i
        merges: dict[int, int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            left, right = merge if isinstance(merge, list) else merge.split(" ")
            merges.setdefault(ids[left] << _SHIFT | ids[right], rank << _SHIFT | ids[left + right])
        keys = np.fromiter(merges, np.int64, len(merges))
        order = np.argsort(keys)
        #: pairs of ids in order, and rank and id of what each becomes, each packed into one number
        self.pair_keys = keys[order]
        self.pair_made = np.fromiter(merges.values(), np.int64, len(keys))[order]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        pieces |= {i: t.encode() for t, i in self.special.items()}
        #: the bytes behind each id
        self.tokens = pa.array([pieces.get(i, b"") for i in range(max(pieces, default=-1) + 1)], pa.large_binary())

    @cached_property
    def merges(self) -> dict[int, int]:
        """Pair of ids -> rank and id of what it becomes; made where a long word first asks for it."""
        return dict(zip(self.pair_keys.tolist(), self.pair_made.tolist()))

    def __getstate__(self) -> dict:
        return {k: v for k, v in vars(self).items() if k != "merges"}

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Exact merges of each word, as int32 ids: always the pair of lowest rank, the leftmost of
        equals. Words of alike length go through their merges in step."""
        out: list[bytes] = [b""] * len(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        for i in np.flatnonzero(sizes > _WIDTHS[-1]).tolist():
            out[i] = array("i", self._merge_long([self.bytes_id[b] for b in words[i]])).tobytes()
        for low, width in zip((0, *_WIDTHS), _WIDTHS):
            rows = np.flatnonzero((sizes > low) & (sizes <= width))
            for at in range(0, len(rows), _MERGE_ROWS):
                part = rows[at:at + _MERGE_ROWS]
                ids, counts = self._merge_rows([words[i] for i in part.tolist()], sizes[part], width)
                data, ends = ids.tobytes(), np.cumsum(counts * 4).tolist()
                for i, lo, hi in zip(part.tolist(), [0, *ends], ends):
                    out[i] = data[lo:hi]
        return out

    def _known(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Packed rank and id of the pairs that merge, ``_NO_MERGE`` for others."""
        key = left.astype(np.int64) << _SHIFT | right
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_made[at], _NO_MERGE)

    def _merge_rows(self, words: list[bytes], sizes: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, how many each has). Each place of a word knows the next and the
        previous one that is left, and the rank of the pair it begins."""
        n, places = len(words), np.arange(width)
        inside = places < sizes[:, None]
        parts = np.full((n, width), -1, np.int32)
        parts[inside] = np.array(self.bytes_id, np.int32)[np.frombuffer(b"".join(words), np.uint8)]
        ranks = np.full((n, width), _NO_MERGE, np.int64)
        pairs = inside[:, 1:]
        if len(self.pair_keys):
            ranks[:, :-1][pairs] = self._known(parts[:, :-1][pairs], parts[:, 1:][pairs])
        nxt = np.tile(places.astype(np.int32) + 1, (n, 1))
        prv = nxt - 2
        live = np.arange(n)
        while True:
            i = ranks[live].argmin(axis=1)
            best = ranks[live, i]
            some = best < _NO_MERGE
            live, i, best = live[some], i[some], best[some]
            if not len(live):
                break
            j = nxt[live, i]
            made = (best & _MASK).astype(np.int32)
            parts[live, i], parts[live, j], ranks[live, j] = made, -1, _NO_MERGE
            after, before = nxt[live, j], prv[live, i]
            nxt[live, i] = after
            ranks[live, i] = _NO_MERGE
            on = np.flatnonzero(after < sizes[live])
            prv[live[on], after[on]] = i[on]
            ranks[live[on], i[on]] = self._known(made[on], parts[live[on], after[on]])
            on = np.flatnonzero(before >= 0)
            ranks[live[on], before[on]] = self._known(parts[live[on], before[on]], made[on])
        left = parts >= 0
        return parts[left], left.sum(axis=1)

    def _merge_long(self, parts: list[int]) -> list[int]:
        """Merges of one long word by a heap of pairs over a linked list, near linear in the word's length."""
        known = self.merges.get
        n = len(parts)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(m, i) for i in range(n - 1) if (m := known(parts[i] << _SHIFT | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            best, i = heapq.heappop(heap)
            j = nxt[i]
            if parts[i] < 0 or j >= n or known(parts[i] << _SHIFT | parts[j]) != best:
                continue  # an earlier merge has used one side
            made = parts[i] = best & _MASK
            parts[j] = -1
            nxt[i] = nxt[j]
            if nxt[i] < n:
                prv[nxt[i]] = i
                if (m := known(made << _SHIFT | parts[nxt[i]])) is not None:
                    heapq.heappush(heap, (m, i))
            if prv[i] >= 0 and (m := known(parts[prv[i]] << _SHIFT | made)) is not None:
                heapq.heappush(heap, (m, prv[i]))
        return [p for p in parts if p >= 0]


_SHIFT = 24
_MASK = (1 << _SHIFT) - 1
_NO_MERGE = 1 << 60
#: Longest words, in bytes, that go through their merges in step, and how many at a time.
_WIDTHS, _MERGE_ROWS = (8, 16, 32, 64), 8192
_WORDS = regex.compile(PATTERN)


#: White space beyond one byte, and the first bytes of its characters.
_FAR_SPACES = np.array([c for c in range(0x80, 0x3001) if regex.match(r"\s", chr(c))])
_FAR_LEAD = byte_class({chr(c).encode()[0] for c in _FAR_SPACES})
_NEAR_SPACE = byte_class({c for c in range(0x80) if regex.match(r"\s", chr(c))})


def blocks(batches, name: str, size: int = BLOCK_BYTES):
    """(batch, texts) with the rows cut so that the texts have about ``size`` bytes; null as empty."""
    for batch in batches:
        texts = pc.fill_null(batch.column(name), "").cast(pa.large_string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False))
        lo = 0
        while lo < len(texts):
            passed = ends[lo - 1] if lo else 0
            hi = max(lo + 1, int(np.searchsorted(ends, passed + size, "right")))
            yield batch.slice(lo, hi - lo), texts.slice(lo, hi - lo)
            lo = hi


def distinct_pieces(texts: pa.LargeStringArray) -> tuple[pa.Array, pa.Array, np.ndarray]:
    """(distinct pieces, each piece's number among them in order of the texts, each text's first
    piece and the count of all). A piece begins where its text does, and at each space that a
    non-space follows; the texts' bytes are not copied for it."""
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset:texts.offset + len(texts) + 1]
    base, size = bounds[0], bounds[-1] - bounds[0]
    bounds = bounds - base
    if not size:
        return texts.slice(0, 0), pa.array([], pa.int32()), np.zeros(len(texts) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[base:base + size]
    at = np.flatnonzero(raw[:-1] == 0x20)
    at = at[~_NEAR_SPACE[raw[at + 1]]]
    far = np.flatnonzero(_FAR_LEAD[raw[at + 1]])
    if len(far):
        a, b, c = (raw[np.minimum(at[far] + k, size - 1)].astype(np.int64) & 0x3F for k in (1, 2, 3))
        two = raw[at[far] + 1] < 0xE0
        code = np.where(two, (a & 0x1F) << 6 | b, (a & 0x0F) << 12 | b << 6 | c)
        at = np.delete(at, far[np.isin(code, _FAR_SPACES)])
    begins = np.zeros(size, bool)
    begins[at] = True
    some = bounds[:-1] < bounds[1:]
    begins[bounds[1:][some] - 1] = False  # what follows belongs to the next text
    begins[bounds[:-1][some]] = True
    starts = np.flatnonzero(begins)
    edges = np.append(starts, size) + base
    pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(edges), data).dictionary_encode()
    return pieces.dictionary, pieces.indices, np.searchsorted(starts, bounds)


def joined(values: pa.Array, order: pa.Array) -> tuple[pa.Buffer, np.ndarray]:
    """The bytes of ``values`` in the given order, and where each begins, with the end of all."""
    taken = values.take(order)
    _, offsets, data = taken.buffers()
    if not len(taken):
        return pa.py_buffer(b""), np.zeros(1, np.int64)
    return data or pa.py_buffer(b""), np.frombuffer(offsets, np.int64)[taken.offset:taken.offset + len(taken) + 1]


class Memo:
    """Remembers the results of at least the last ``MEMO_PIECES / 2`` new keys: when the younger
    half is full it becomes the older one, from which keys that are still asked for come back."""

    def __init__(self) -> None:
        self.young: dict = {}
        self.old: dict = {}

    def missing(self, keys: set) -> set:
        """The keys without a result; all others are in ``young`` afterwards."""
        absent = keys.difference(self.young)
        if len(self.young) + len(absent) > MEMO_PIECES // 2 + len(keys):
            self.old, self.young, absent = self.young, {}, keys
        back = absent.intersection(self.old)
        for k in back:
            self.young[k] = self.old[k]
        return absent - back


class Encoder:
    """Encodes blocks of texts; remembers a bounded number of pieces and words."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon) -> None:
        self.vocabulary, self.lexicon = vocabulary, lexicon
        #: int32 ids, as bytes
        self.pieces, self.words = Memo(), Memo()
        marks = sorted(vocabulary.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, marks)) + ")") if marks else None

    def word_ids(self, words: list[str]) -> list[bytes]:
        """Ids of words: the lexicon's, or exactly merged ones."""
        raw = [w.encode() for w in words]
        numbers = self.lexicon.lookup(raw).tolist()
        merged = iter(self.vocabulary.merge([r for r, n in zip(raw, numbers) if n < 0]))
        token_bytes = self.lexicon.token_bytes
        return [token_bytes(n) if n >= 0 else next(merged) for n in numbers]

    def piece_ids(self, pieces: list[str]) -> list[bytes]:
        """Ids of distinct pieces. Long pieces and words are forgotten at once."""
        new = list(self.pieces.missing(set(pieces)))
        flat: list[str] = []
        sizes = []
        for p in new:
            parts = _WORDS.findall(p)
            flat += parts
            sizes.append(len(parts))
        ask = list(self.words.missing(set(flat)))
        words, memo = self.words.young, self.pieces.young
        words.update(zip(ask, self.word_ids(ask)))
        ids = [words[w] for w in flat]
        at = 0
        for p, n in zip(new, sizes):
            memo[p] = ids[at] if n == 1 else b"".join(ids[at:at + n])
            at += n
        out = [memo[p] for p in pieces]
        for p in new:
            if len(p) > _SHORT:
                del memo[p]
        for w in ask:
            if len(w) > _SHORT:
                del words[w]
        return out

    def plain(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and the count of all), special tokens apart."""
        pieces, order, first = distinct_pieces(texts)
        data, at = joined(pa.array(self.piece_ids(pieces.to_pylist()), pa.large_binary()), order)
        return np.frombuffer(data, np.int32, at[-1] // 4), at[first] // 4

    def encode(self, texts: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text's begin and the count of all)."""
        if not any(pc.any(pc.match_substring(texts, s)).as_py() for s in self.vocabulary.special):
            return self.plain(texts)
        owners, runs = [], []
        for i, text in enumerate(texts.to_pylist()):
            cut = self.special.split(text)
            owners += [i] * len(cut)
            runs += [(k % 2 == 1, t) for k, t in enumerate(cut)]
        ids, at = self.plain(pa.array(["" if special else t for special, t in runs], pa.large_string()))
        parts = [np.array([self.vocabulary.special[t]], np.int32) if special else ids[a:b]
                 for (special, t), a, b in zip(runs, at[:-1], at[1:])]
        counts = np.bincount(owners, [len(p) for p in parts], len(texts)).astype(np.int64)
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(counts)))

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> pa.StringArray:
        """The text of each run of ids, from the bytes that stand behind each id."""
        data, at = joined(self.vocabulary.tokens, pa.array(ids, pa.int32()))
        raw = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(bounds) - 1,
                                               [None, pa.py_buffer(np.ascontiguousarray(at[bounds])), data])
        try:
            return raw.cast(pa.large_string()).cast(pa.string())
        except pa.ArrowInvalid:  # not UTF-8
            return pa.array([t.decode("utf-8", "replace") for t in raw.to_pylist()], pa.string())


def word_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(word, n): how often each word of the pattern occurs in all texts.

    Pieces are counted first (in each block, then by a grouped sum), and only distinct pieces are
    split into words, so the pattern runs once for each.
    """
    def count(batches):
        for _, texts in blocks(batches, text):
            pieces, order, _ = distinct_pieces(texts)
            n = np.bincount(order.to_numpy(), minlength=len(pieces))
            yield pa.RecordBatch.from_arrays([pieces.cast(pa.string()), pa.array(n, pa.int64())], names=["word", "n"])

    def split(batches):
        for batch in batches:
            seen: Counter[str] = Counter()
            for piece, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist()):
                for w in _WORDS.findall(piece):
                    seen[w] += n
            yield _counted(seen)

    schema = "word string, n long"
    pieces = map_arrow(docs.select(text), count, schema).groupBy("word").agg(F.sum("n").alias("n"))
    return map_arrow(pieces, split, schema).groupBy("word").agg(F.sum("n").alias("n"))


def _counted(seen: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())],
                                      names=["word", "n"])


def frequent_words(counts: DataFrame, most: int = LEXICON_WORDS) -> list[str]:
    """At most ``most`` words, all those above a common count.

    The count comes from a histogram of counts in at most 1,024 classes, so neither the driver
    nor one task sees more words than it returns.
    """
    kind = F.floor(F.log2("n") * 16).cast("int")
    counts = checkpointed(counts.filter(F.length("word") <= 64))
    total, least = 0, None
    for row in sorted(counts.groupBy(kind.alias("kind")).agg(F.count("*").alias("size")).collect(), reverse=True):
        if total + row["size"] > most:
            break
        total, least = total + row["size"], row["kind"]
    if least is None:
        return []
    return [r["word"] for r in counts.filter(kind >= least).select("word").collect()]


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", most: int = LEXICON_WORDS) -> bytes:
    """The compiled automaton of the frequent words of all texts."""
    words = [w.encode() for w in frequent_words(word_counts(docs, text), most)]
    return compile_lexicon({w: np.frombuffer(ids, np.int32).tolist() for w, ids in zip(words, vocabulary.merge(words))})


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text: str = "text",
           keep: tuple[str, ...] = (), most: int = LEXICON_WORDS) -> DataFrame:
    """(id, ``keep`` columns, token_ids array<int>, decoded string) for every row of ``docs``.

    ``tokenizer`` is the path of a byte-level BPE file, read on the driver. Special tokens in a
    text become their ids; none are added. ``decoded`` is made from the ids alone. Null and empty
    texts give no ids and an empty text. Null and repeated ids keep their rows. The lexicon only
    saves work: a text's ids don't depend on it.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = Vocabulary(f.read())
    sent = spark.sparkContext.broadcast((vocabulary, build_lexicon(docs, vocabulary, text, most)))
    carried = [id_col, *keep]

    def run(batches):
        encoder = Encoder(sent.value[0], Lexicon(sent.value[1]))
        for batch, texts in blocks(batches, text, ENCODE_BYTES):
            ids, bounds = encoder.encode(texts)
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in carried], pa.ListArray.from_arrays(bounds.astype(np.int32), ids),
                 encoder.decode(ids, bounds)], names=names)

    names = [*carried, "token_ids", "decoded"]
    kinds = ", ".join(f"`{c}` {column_type(docs, c)}" for c in carried)
    return map_arrow(
        docs.select(*carried, *([text] if text not in carried else [])), run, f"{kinds}, token_ids array<int>, decoded string")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of encoded rows."""
    return encoded.select(
        id_col, F.size("token_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("token_ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
