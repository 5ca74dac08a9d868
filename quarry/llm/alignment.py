"""Alignment of two tokenizers' tokens over the bytes of a text, and how often their ids meet.

Coarse cuts come from the libraries: the character offsets of the byte-level tokenizer and the
spans of the sentencepiece proto (its former immutable proto; this release calls it "proto").
Where a token ends inside a character, or a byte-fallback piece has no span of its own, the cut is
refined with the decoded bytes of the tokens since the last coarse cut. Byte offsets where tokens
of both end cut the tokens into groups, and all pairs within a group are links.

A single space between two characters that are no white space ends a token in both tokenizers, and
what stands between two such spaces, an atom, is encoded alike wherever it stands. So a
worker encodes each atom it meets once, many of them joined in one call, and puts the documents
together.

Documents are kept in chunks of bounded text size, each with a dictionary of its linked id
pairs: only a chunk's distinct pairs are counted over the corpus and joined with those counts,
never the links of single documents.
"""

from __future__ import annotations

import hashlib
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.bpe import byte_chars
from quarry.llm.common import byte_texts, checkpointed, drop_written, map_arrow, slices, written

#: Text bytes of a chunk, of a long text that are cut together, and of atoms that are encoded together.
CHUNK_BYTES, PART_BYTES, CALL_BYTES = 4 << 20, 1 << 20, 1 << 16
#: Links of one group that are made one by one; beyond them ids are counted first.
GROUP_LINKS = 1 << 16
#: Atoms and links that a Python worker remembers; beyond them it keeps the more frequent half.
KNOWN_ATOMS, KNOWN_LINKS = 300_000, 6_000_000
#: The spaces that atoms are cut at, and atoms that may be joined: both neighbours are printable ASCII or
#: two-byte characters from U+00C0 on, among which there is no white space.
_BEFORE, _AFTER = rb"(?:[\x21-\x7E]|[\xC3-\xDF][\x80-\xBF])", rb"[\x21-\x7E\xC3-\xDF]"
_CUT = regex.compile(rb"(?<=" + _BEFORE + rb") (?=" + _AFTER + rb")")
_JOINABLE = regex.compile(rb"(?s)" + _AFTER + rb"(?:.*" + _BEFORE + rb")?")
_SPACE = "▁"


def _token_table(names: dict[int, bytes]) -> tuple[list[bytes], np.ndarray]:
    size = max(names, default=-1) + 1
    table = [names.get(i, b"") for i in range(size)]
    return table, np.fromiter(map(len, table), np.int64, size)


class ByteLevel:
    """The byte-level tokenizer: ids, exact token ends, and the bytes of each token."""

    def __init__(self, source: bytes) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_buffer(source)
        self.tokenizer.encode_special_tokens = True
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        chars = byte_chars()
        self.bytes, self.sizes = _token_table(
            {i: bytes(chars[c] for c in t) for t, i in self.tokenizer.get_vocab(with_added_tokens=False).items()})

    def tokens(self, text: str, raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte end of each token) of a text given as string and as UTF-8 bytes."""
        found = self.tokenizer.encode(text, add_special_tokens=False)
        ids = np.array(found.ids, np.int64)
        ends = np.array([e for _, e in found.offsets], np.int64)
        if len(text) != len(raw):  # characters to bytes
            begins = np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))
            ends = begins[ends]
        # Of tokens that end in one character only the last ends with it.
        coarse = np.append(ends[1:] != ends[:-1], True) if len(ends) else np.zeros(0, bool)
        return ids, refined(ends, coarse, self.sizes[ids])


class Pieces:
    """The sentencepiece tokenizer, which puts a space before the text."""

    def __init__(self, source: bytes) -> None:
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_proto=source)
        names, self.fallback = {}, np.zeros(self.model.get_piece_size(), bool)
        for i in range(self.model.get_piece_size()):
            piece = self.model.id_to_piece(i)
            self.fallback[i] = self.model.is_byte(i)
            names[i] = bytes([int(piece[1:-1], 16)]) if self.fallback[i] else piece.replace(_SPACE, " ").encode()
        #: Whether a cut before a space loses nothing: no piece has a space behind anything else.
        self.cuttable = not any(b" " in t.lstrip(b" ") for i, t in names.items() if not self.fallback[i])
        self.bytes, self.sizes = _token_table(names)

    def tokens(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(ids, byte end of each token) of a space and the text."""
        found = self.model.encode(text, return_type="proto").pieces
        ids, ends = (np.array(x, np.int64) for x in ([p.id for p in found], [p.end for p in found]))
        # Spans follow each other; byte-fallback pieces of one character share its span, which only
        # the last of them has.
        coarse = ~(self.fallback[ids] & (np.diff(ends, prepend=0) == 0))
        return ids, refined(ends + 1, coarse, self.sizes[ids])


def refined(ends: np.ndarray, coarse: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact ends: coarse cuts as they are, tokens between them by their bytes since the last cut."""
    if coarse.all():
        return ends
    upto = np.cumsum(sizes)
    at = np.maximum.accumulate(np.where(coarse, np.arange(len(ends)), -1))
    since = np.where(at >= 0, ends[at] - upto[at], 0)
    return np.where(coarse, ends, upto + since)


def parts(raw: bytes, size: int = PART_BYTES) -> Iterator[list[bytes]]:
    """The atoms of a whole text, in lists from about ``size`` bytes of it."""
    lo = 0
    while True:
        cut = _CUT.search(raw, lo + size) if len(raw) - lo > size else None
        yield _CUT.split(raw[lo:cut.start()] if cut else raw[lo:])
        if not cut:
            return
        lo = cut.end()


class _Grown:
    """A numpy array that grows at its end."""

    def __init__(self, kind: type) -> None:
        self.data, self.size = np.zeros(1024, kind), 0

    def add(self, values: np.ndarray) -> None:
        if self.size + len(values) > len(self.data):
            self.data = np.concatenate((self.data[:self.size], np.zeros(self.size + len(values), self.data.dtype)))
        self.data[self.size:self.size + len(values)] = values
        self.size += len(values)


class Atoms:
    """What a task knows of the atoms it met: counts of tokens, groups and links, the text of the
    groups, and the links as id pairs (first id * size of the second vocabulary + second id)."""

    def __init__(self, a: ByteLevel, b: Pieces, texts: tuple[np.ndarray, ...]) -> None:
        self.a, self.b, self.id_texts = a, b, texts
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {}
        self.texts: list[bytes] = []
        self.unsound: set[int] = set()
        self.used = _Grown(np.int64)
        self.counts = [_Grown(np.int64) for _ in range(4)]  # tokens of both, groups, links
        self.ends = _Grown(np.int64)
        self.ends.add(np.zeros(1, np.int64))
        self.pairs, self.times = _Grown(np.int64), _Grown(np.int64)

    def bound(self) -> None:
        """Keeps the more frequent half at most where too much is known."""
        n = len(self.texts)
        if n <= KNOWN_ATOMS and self.pairs.size <= KNOWN_LINKS:
            return
        used, first = self.used.data[:n], self.ends.data[:n]
        size = self.ends.data[1:n + 1] - first
        keep = np.argsort(-used, kind="stable")[:KNOWN_ATOMS // 2]
        keep = np.sort(keep[(used[keep] > 1) & (np.cumsum(size[keep]) <= KNOWN_LINKS // 2)])
        names, old = list(self.index), (self.texts, self.unsound, self.counts, self.pairs, self.times)
        flat = np.repeat(first[keep] - np.cumsum(size[keep]) + size[keep], size[keep]) + np.arange(int(size[keep].sum()))
        ends, used = np.cumsum(size[keep]), used[keep] // 2
        self.forget()
        self.index = {names[i]: at for at, i in enumerate(keep.tolist())}
        self.texts = [old[0][i] for i in keep.tolist()]
        self.unsound = {at for at, i in enumerate(keep.tolist()) if i in old[1]} if old[1] else set()
        for grown, was in zip(self.counts, old[2]):
            grown.add(was.data[keep])
        self.ends.add(ends)
        self.pairs.add(old[3].data[flat])
        self.times.add(old[4].data[flat])
        self.used.add(used)

    def learn(self, atoms: set[bytes]) -> None:
        """Encodes the atoms that are not known yet."""
        joined, size = [], 0
        for atom in atoms.difference(self.index):
            if not _JOINABLE.fullmatch(atom):
                self._encode([atom])
                continue
            joined.append(atom)
            size += len(atom) + 1
            if size >= CALL_BYTES:
                self._encode(joined)
                joined, size = [], 0
        if joined:
            self._encode(joined)

    def _encode(self, atoms: list[bytes]) -> None:
        raw = b" ".join(atoms)
        text, spaced = raw.decode("utf-8", "replace"), b" " + raw
        ids_a, ends_a = self.a.tokens(" " + text, np.frombuffer(spaced, np.uint8))
        ids_b, ends_b = self.b.tokens(text)
        edges = np.cumsum([len(x) + 1 for x in atoms])
        spelled = all(b"".join(map(t.bytes.__getitem__, ids.tolist())) == spaced for t, ids in ((self.a, ids_a), (self.b, ids_b)))
        if spelled and np.isin(edges, ends_a).all() and np.isin(edges, ends_b).all():
            self._add(atoms, edges, ids_a, ids_b, ends_a, ends_b)
        elif len(atoms) > 1:
            for atom in atoms:
                self._encode([atom])
        else:
            none = np.zeros(0, np.int64)
            self._add(atoms, edges, none, none, none, none)
            self.unsound.add(len(self.texts) - 1)

    def _add(self, atoms: list[bytes], edges: np.ndarray, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray,
             ends_b: np.ndarray) -> None:
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        group_a, group_b = np.searchsorted(cuts, ends_a), np.searchsorted(cuts, ends_b)
        groups = np.arange(len(cuts) + 1)
        at_a, at_b = np.searchsorted(group_a, groups), np.searchsorted(group_b, groups)
        of_a, of_b = np.diff(at_a), np.diff(at_b)
        # The group text: ids and their separators, in one object array in the order of the text.
        comma_a, bar, comma_b, semicolon = self.id_texts
        out = np.empty(len(a) + len(b), object)
        last_a = np.arange(len(a)) == at_a[group_a + 1] - 1
        last_b = np.arange(len(b)) == at_b[group_b + 1] - 1
        out[np.arange(len(a)) + at_b[group_a]] = np.where(last_a, bar[a], comma_a[a])
        out[np.arange(len(b)) + at_a[group_b + 1]] = np.where(last_b, semicolon[b], comma_b[b])
        links = of_a * of_b
        # Atom by atom: the tokens, groups and links up to its end.
        upto = np.searchsorted(cuts, edges, "right")
        to_a, to_b = at_a[upto], at_b[upto]
        to_links = np.append(0, np.cumsum(links))[upto]
        for grown, to in zip(self.counts, (to_a, to_b, upto, to_links)):
            grown.add(np.diff(to, prepend=0))
        said, lo = out.tolist(), 0
        for hi in (to_a + to_b).tolist():
            self.texts.append(b"".join(said[lo:hi])[:-1])
            lo = hi
        pairs, times, made = _links(a, b, group_a, at_a, at_b, of_b, links, len(self.b.bytes))
        self.ends.add(self.pairs.size + made[upto])
        self.pairs.add(pairs)
        self.times.add(times)
        self.used.add(np.zeros(len(atoms), np.int64))
        for at, atom in enumerate(atoms, len(self.texts) - len(atoms)):
            self.index[atom] = at


def _links(a: np.ndarray, b: np.ndarray, group_a: np.ndarray, at_a: np.ndarray, at_b: np.ndarray, of_b: np.ndarray,
           links: np.ndarray, n_b_ids: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(pairs, how often each is linked, pairs before each group and after the last)."""
    few = links <= GROUP_LINKS
    if few.all():
        each = of_b[group_a]
        first = np.repeat(at_b[group_a] - np.cumsum(each) + each, each)
        pairs = np.repeat(a, each) * n_b_ids + b[np.arange(len(first)) + first]
        return pairs, np.ones(len(pairs), np.int64), np.append(0, np.cumsum(links))
    found, counted = [], []
    for g in range(len(links)):
        (u, n), (v, m) = (np.unique(x, return_counts=True) for x in (a[at_a[g]:at_a[g + 1]], b[at_b[g]:at_b[g + 1]]))
        found.append((u[:, None] * n_b_ids + v).ravel())
        counted.append((n[:, None] * m).ravel())
    return np.concatenate(found), np.concatenate(counted), np.append(0, np.cumsum([len(x) for x in found]))


@dataclass(frozen=True)
class Aligned:
    """One document: tokens of both, groups and links, the hash of its groups, its distinct linked
    pairs and how often each is linked."""

    counts: tuple[int, int, int, int]
    digest: str
    pairs: np.ndarray
    times: np.ndarray


def aligned(raws: list[bytes], known: Atoms, size: int = PART_BYTES) -> list[Aligned | None]:
    """The alignments of some texts, put together from their atoms; None where a text has no tokens:
    an empty one, or one whose joined token bytes differ from a space and the text."""
    pieces = [[x for part in parts(raw, size) for x in part] if known.b.cuttable else [raw] for raw in raws]
    known.learn(set().union(*pieces) - {b""})
    places = [list(map(known.index.__getitem__, atoms)) if raw else [] for raw, atoms in zip(raws, pieces)]
    if known.unsound:
        places = [[] if known.unsound.intersection(at) else at for at in places]
    where = np.fromiter(chain.from_iterable(places), np.int64)
    known.used.data[:known.used.size] += np.bincount(where, minlength=known.used.size)
    owner = np.repeat(np.arange(len(raws)), [len(at) for at in places])
    counts = [np.bincount(owner, g.data[where], len(raws)).astype(np.int64).tolist() for g in known.counts]
    first = known.ends.data[where]
    n = known.ends.data[where + 1] - first
    flat = np.repeat(first - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
    span = len(known.a.bytes) * len(known.b.bytes)  # document and pair in one number
    keys, order = np.unique(np.repeat(owner, n) * span + known.pairs.data[flat], return_inverse=True)
    times = np.bincount(order, known.times.data[flat], len(keys)).astype(np.int64)
    at = np.searchsorted(keys, np.arange(len(raws) + 1) * span)
    return [Aligned(tuple(c[i] for c in counts), hashlib.sha256(b";".join(map(known.texts.__getitem__, own))).hexdigest(),
                    keys[at[i]:at[i + 1]] - i * span, times[at[i]:at[i + 1]]) if own else None
            for i, own in enumerate(places)]


def _id_texts(n_a: int, n_b: int) -> tuple[np.ndarray, ...]:
    made = lambda n, mark: np.array([b"%d%s" % (i, mark) for i in range(n)], object)
    return made(n_a, b","), made(n_a, b"|"), made(n_b, b","), made(n_b, b";")


@lru_cache(maxsize=1)
def _known(source_a: bytes, source_b: bytes) -> Atoms:
    """The atoms that this Python worker has met, in whatever tasks."""
    a, b = ByteLevel(source_a), Pieces(source_b)
    return Atoms(a, b, _id_texts(len(a.bytes), len(b.bytes)))


_CHUNK = pa.schema([("chunk", pa.string()), ("pairs", pa.list_(pa.int64())), ("held", pa.list_(pa.int32())),
                    ("doc_id", pa.list_(pa.int64())), ("n_a", pa.list_(pa.int64())), ("n_b", pa.list_(pa.int64())),
                    ("n_groups", pa.list_(pa.int64())), ("n_links", pa.list_(pa.int64())),
                    ("groups_sha256", pa.list_(pa.string())), ("n_pairs", pa.list_(pa.int32())),
                    ("codes", pa.binary()), ("times", pa.binary())])
_CHUNK_DDL = ("chunk string, pairs array<long>, held array<int>, doc_id array<long>, n_a array<long>, n_b array<long>, "
              "n_groups array<long>, n_links array<long>, groups_sha256 array<string>, n_pairs array<int>, "
              "codes binary, times binary")


def _chunk(rows: list[tuple]) -> pa.RecordBatch:
    """One row for a chunk of documents. ``pairs`` is its dictionary and ``held`` the number of its
    documents with each pair; ``codes`` and ``times`` (32-bit) list the documents' pairs."""
    ids, counts, pairs, times = zip(*rows)
    words, codes = np.unique(np.concatenate(pairs), return_inverse=True)
    held = np.bincount(codes, minlength=len(words)).astype(np.int32)
    values = [[uuid.uuid4().hex], [words], [held], [list(ids)], *[[list(c)] for c in zip(*counts)],
              [[len(p) for p in pairs]], [codes.astype(np.int32).tobytes()],
              [np.concatenate(times).astype(np.int64).tobytes()]]
    return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(values, _CHUNK)], schema=_CHUNK)


def chunks(docs: DataFrame, id_col: str, text: str, path_a: str, path_b: str) -> DataFrame:
    """The documents encoded and aligned, in chunks. The tokenizers' files are read by the driver
    and sent, so the executors need none."""
    spark = docs.sparkSession
    with open(path_a, "rb") as f, open(path_b, "rb") as g:
        sent = spark.sparkContext.broadcast((f.read(), g.read()))

    def run(batches):
        known, rows, held = _known(*sent.value), [], 0
        for batch in slices(batches):
            known.bound()
            raws = byte_texts(batch, "text")
            for doc, raw, got in zip(batch.column("id").to_pylist(), raws, aligned(raws, known)):
                if got is None:
                    rows.append((doc, (0, 0, 0, 0, ""), np.zeros(0, np.int64), np.zeros(0, np.int64)))
                else:
                    rows.append((doc, (*got.counts, got.digest), got.pairs, got.times))
                held += len(raw) + 64
                if held >= CHUNK_BYTES:
                    yield _chunk(rows)
                    rows, held = [], 0
        if rows:
            yield _chunk(rows)

    return map_arrow(docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text")), run, _CHUNK_DDL)


def pair_counts(made: DataFrame, n_b_ids: int) -> DataFrame:
    """(pair, n, best): the documents that hold a pair linked, corpus-wide, and whether no pair of
    the same first id has more. A first id has at most as many pairs as the second vocabulary."""
    told = made.select(F.explode(F.arrays_zip("pairs", "held")).alias("p")).groupBy(F.col("p.pairs").alias("pair")) \
        .agg(F.sum(F.col("p.held").cast("long")).alias("n"))
    first = Window.partitionBy(F.expr(f"pair div {n_b_ids}"))
    return told.withColumn("best", F.col("n") == F.max("n").over(first))


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Null and empty texts, and those whose tokens don't spell a space and the text (such as texts
    with U+2581, which decodes to a space), have no tokens: zeros and an empty hash. Every row is
    a document of its own, also where ids repeat or are null. Ties for an id's highest count all
    count as best. A very long text is encoded in parts that end before a space between letters
    or digits, where both tokenizers cut anyway; one without such a place is encoded whole. An
    empty table gives no rows; other columns are not read.
    """
    import sentencepiece

    n_b_ids = sentencepiece.SentencePieceProcessor(model_file=path_b).get_piece_size()
    made, path = written(chunks(docs, id_col, text, path_a, path_b), "aligned")
    counts = pair_counts(made, n_b_ids)
    asked = made.select("chunk", F.posexplode("pairs").alias("at", "pair"))
    told = (asked.join(counts, "pair").groupBy("chunk")  # bounded by a chunk's dictionary
            .agg(F.collect_list(F.struct("at", "n", "best")).alias("told")))
    both = made.drop("pairs", "held").join(told, "chunk", "left")

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                yield _scored(batch.slice(i, 1))

    out = checkpointed(map_arrow(both, run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, "
                                            "n_best long, count_sum long, groups_sha256 string"))
    drop_written(docs.sparkSession, path)
    return out


def _scored(row: pa.RecordBatch) -> pa.RecordBatch:
    """A chunk's documents with what the corpus-wide counts say of their links."""
    col = lambda name: row.column(name).flatten()
    at, n, best = col("told").flatten() if row.column("told").null_count == 0 else (np.zeros(0, np.int64),) * 3
    at = np.asarray(at)
    counts, first = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
    counts[at], first[at] = np.asarray(n), np.asarray(best)
    codes = np.frombuffer(row.column("codes")[0].as_py(), np.int32)
    times = np.frombuffer(row.column("times")[0].as_py(), np.int64)
    ends = np.cumsum(col("n_pairs").to_numpy(zero_copy_only=False)).astype(np.int64)
    over = lambda x: np.diff(np.append(0, np.append(0, np.cumsum(x))[ends]))
    return pa.RecordBatch.from_arrays(
        [col("doc_id"), col("n_a"), col("n_b"), col("n_groups"), col("n_links"),
         pa.array(over(times * first[codes]), pa.int64()), pa.array(over(times * counts[codes]), pa.int64()),
         col("groups_sha256")],
        names=["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])
