"""Benchmark decontamination: rare n-gram seeds join training passages to test items, and
Smith-Waterman alignment scores exact, edited and paraphrased copies. The seeds miss no passage
that the alignment accepts."""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import WORD_BYTE, byte_texts, column_type, lower_ascii, map_arrow, slices
from quarry.llm.wordhash import hashed_words, mix

#: Alignment: a matching word, a changed word, a word left out or put in.
MATCH, CHANGE, GAP = 1.0, -0.5, -0.5
#: A passage is a copy from this share of the best possible score on.
LEAST = 0.4
#: A copy scores as much as so many equal words at least, or as the whole item if that is shorter.
FEWEST = 5
#: Bytes of test items that are broadcast at once.
ITEM_BYTES = 32 << 20
#: Words of a text that are aligned at once, besides an overlap as long as a copy can be.
ALIGNED = 1 << 16
_FILTER_BITS = 22


def align(passage: np.ndarray, item: np.ndarray) -> tuple[float, int, int]:
    """Best local alignment of two sequences of word hashes: its score, and the first and the
    last-but-one word of the passage that it covers.

    A row of the table is one item word. Left moves of a row are a running maximum; the start of
    the best alignment comes along with each cell.
    """
    n = len(passage)
    steps = np.arange(n + 1) * GAP
    score = np.zeros(n + 1)
    start = np.arange(n + 1)
    best = (0.0, 0, 0)
    for word in item:
        gain = np.where(passage == word, MATCH, CHANGE)
        diagonal, above = score[:-1] + gain, score[1:] + GAP
        now, came = np.zeros(n + 1), np.arange(n + 1)
        up = above > diagonal
        cell = np.where(up, above, diagonal)
        now[1:] = np.maximum(cell, 0)
        came[1:] = np.where(cell > 0, np.where(up, start[1:], start[:-1]), came[1:])
        level = now - steps
        peak = np.maximum.accumulate(level)
        source = np.maximum.accumulate(np.where(level == peak, np.arange(n + 1), 0))
        score = np.maximum(peak + steps, 0)
        start = np.where(peak + steps > 0, came[source], np.arange(n + 1))
        end = int(score.argmax())
        if score[end] > best[0]:
            best = float(score[end]), int(start[end]), end
    return best


def pair_hashes(words: np.ndarray, gap: int) -> np.ndarray:
    """Hashes of all pairs of words that are ``gap`` apart; at 0, of the words themselves."""
    if len(words) <= gap:
        return np.zeros(0, np.uint64)
    return mix(words[:len(words) - gap] * np.uint64(0xD6E8FEB86659FD93) + words[gap:]) if gap else mix(words)


def needed(sizes: np.ndarray, least: float) -> np.ndarray:
    """The least score of a copy of items of so many words: a share of them, but that of ``FEWEST``
    equal words at least, so items of up to so many words must be there whole."""
    return np.maximum(sizes * least, np.minimum(sizes, FEWEST)) * MATCH


class Grams:
    """Pairs of words of a block of items, found in texts by hash.

    A pair is a word and the next one, or the next but one. Let an alignment of ``m`` equal words
    score at least ``need``, so it has at most ``2 * (m - need)`` edits. Two consecutive equal words
    of it that are adjacent on both sides have none between them, those at most two apart on both
    sides one, all others two or more. So twice the number of the first and the number of the
    second, pairs all of them, make at least ``2 * need - 2``. This holds for any order of edits.
    """

    def __init__(self, items: list[np.ndarray], least: float = LEAST) -> None:
        self.items = items
        sizes = np.array([len(words) for words in items], np.int64)
        self.need = needed(sizes, least)
        #: Words of the longest passage that an item can be aligned with.
        self.span = (sizes + 2 * (sizes - self.need)).astype(np.int64) + 1
        hashes, item, offset, tight = [np.zeros(0, np.uint64)], [], [], []
        for i, words in enumerate(items):
            for gap in (0,) if len(words) == 1 else (1, 2):  # an item of one word is that word
                found = pair_hashes(words, gap)
                hashes.append(found)
                item += [i] * len(found)
                offset += range(len(found))
                tight += [gap < 2] * len(found)
        self.hashes, number = np.unique(np.concatenate(hashes), return_inverse=True)
        self.gaps = sorted({g for n in sizes.tolist() if n for g in ((0,) if n == 1 else (1, 2))})
        #: Of each place of a pair: the pair, the item, the offset, and whether its words are adjacent.
        self.places = tuple(np.array(x, np.int64) for x in (number, item, offset, tight))
        self.use(np.ones(len(number), bool), np.zeros(len(items)))

    def use(self, kept: np.ndarray, left_out: np.ndarray) -> None:
        """From now on only the kept places are found; ``left_out`` counts the offsets of each item
        without any."""
        gram, item, _, tight = (x[kept] for x in self.places)
        order = np.argsort(gram, kind="stable")
        self.numbers, self.first, self.many = np.unique(gram[order], return_index=True, return_counts=True)
        self.item, self.tight = item[order], tight[order]
        self.bound = np.maximum(2 * self.need - 2 - 2 * left_out, 1) - 1e-9
        self.wanted = self.hashes[self.numbers]
        self.bits = np.zeros(1 << _FILTER_BITS, bool)
        self.bits[self.wanted >> np.uint64(64 - _FILTER_BITS)] = True

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(places in the text, which of the found pairs are there, whether as adjacent words)."""
        at, which, tight = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for gap in self.gaps if len(self.wanted) else ():
            grams = pair_hashes(words, gap)
            some = np.flatnonzero(self.bits[grams >> np.uint64(64 - _FILTER_BITS)])
            found = np.minimum(np.searchsorted(self.wanted, grams[some]), len(self.wanted) - 1)
            same = self.wanted[found] == grams[some]
            at.append(some[same])
            which.append(found[same])
            tight.append(np.full(int(same.sum()), gap < 2, np.int64))
        return np.concatenate(at), np.concatenate(which), np.concatenate(tight)

    def seeds(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which places of pairs are seeds, and how many offsets of each item are none: those whose
        pairs are the most common, as many as leave half of what an alignment needs."""
        gram, item, offset, _ = self.places
        kept, left_out = np.ones(len(gram), bool), np.zeros(len(self.items))
        ends = np.searchsorted(item, np.arange(len(self.items) + 1))
        for i, words in enumerate(self.items):
            spare = int((self.need[i] - 1) / 2)
            if spare > 0:
                here = slice(ends[i], ends[i + 1])
                uses = np.bincount(offset[here], counts[gram[here]], len(words))
                common = np.argsort(-uses, kind="stable")[:spare]
                kept[here] &= ~np.isin(offset[here], common)
                left_out[i] = spare
        return kept, left_out

    def passages(self, words: np.ndarray) -> dict[int, list[tuple[int, int]]]:
        """The parts of the text, by item, that hold enough seeds for an alignment."""
        at, which, tight = self.hits(words)
        many = self.many[which]
        before = np.cumsum(many) - many
        place = np.repeat(self.first[which] - before, many) + np.arange(int(many.sum()))
        item, weight = self.item[place], 1 + (self.tight[place] & np.repeat(tight, many))
        # a word of the text begins one pair of an alignment at most
        width = len(words) + int(self.span.max(initial=0)) + 1
        key, where = np.unique(item * width + np.repeat(at, many), return_inverse=True)
        most = np.zeros(len(key), np.int64)
        np.maximum.at(most, where, weight)
        total = np.concatenate(([0], np.cumsum(most)))
        item = key // width
        inside = total[np.searchsorted(key, key + self.span[item])] - total[:-1]
        enough = inside >= self.bound[item]
        out: dict[int, list[tuple[int, int]]] = defaultdict(list)
        for i, begin in zip(item[enough].tolist(), (key % width)[enough].tolist()):
            lo, hi = max(0, begin - int(self.span[i])), begin + int(self.span[i])
            if out[i] and lo <= out[i][-1][1]:
                lo = out[i].pop()[0]
            out[i].append((lo, hi))
        return out

    def leaks(self, words: np.ndarray) -> list[tuple[int, float, int, int]]:
        """(item, score, first word, end word) of the best passage of each leaked item."""
        out = []
        for i, parts in self.passages(words).items():
            size, span, best = len(self.items[i]), int(self.span[i]), (0.0, 0, 0)
            for lo, hi in ((a, min(a + ALIGNED + span, hi)) for lo, hi in parts for a in range(lo, hi, ALIGNED)):
                score, first, end = align(words[lo:hi], self.items[i])
                if score > best[0]:
                    best = score, first + lo, end + lo
                if best[0] >= size * MATCH:
                    break
            if best[0] >= self.need[i] - 1e-9:
                out.append((i, best[0] / (size * MATCH), best[1], best[2]))
        return sorted(out)


def _item_blocks(benchmark: DataFrame, id_col: str, text: str):
    """Blocks of test items, each of about ``ITEM_BYTES`` at most, as (id, word hashes)."""
    rows = benchmark.select(F.col(id_col).cast("long").alias("id"), F.coalesce(text, F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text") + 16)).first()[0] or 0
    n = -(-size // ITEM_BYTES)
    for b in range(n):
        block = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == b).orderBy("id", "text").collect()
        yield ([r["id"] for r in block],
               [hashed_words(lower_ascii(r["text"].encode()), WORD_BYTE)[0] for r in block])


def _seeded(docs: DataFrame, items: list[np.ndarray], text: str, least: float) -> Grams:
    """The items' pairs with the seeds chosen by their counts in all documents."""
    grams = Grams(items, least)
    sent = docs.sparkSession.sparkContext.broadcast(grams)

    def count(batches):
        totals = np.zeros(len(sent.value.hashes), np.int64)
        for batch in slices(batches):
            for t in byte_texts(batch, text):
                np.add.at(totals, sent.value.hits(hashed_words(lower_ascii(t), WORD_BYTE)[0])[1], 1)
        some = np.flatnonzero(totals)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(totals[some])], names=["gram", "n"])

    counts = np.zeros(len(grams.hashes), np.int64)
    found = map_arrow(docs.select(text), count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    for r in found.collect():  # at most the pairs of one block of items
        counts[r["gram"]] = r["n"]
    grams.use(*grams.seeds(counts))
    return grams


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
               text: str = "text", least: float = LEAST) -> DataFrame:
    """(id, item, score, first_word, end_word): every pair of a document and a test item of which
    it holds a copy, with the best copy's share of the full alignment score and its words
    (from 0; ``end_word`` not included).

    Texts have A-Z lower-cased; words are runs of letters, digits and non-ASCII characters. All
    whole texts are searched, and scores are those of the full alignment. Items without words and null texts match nothing; items of
    up to ``FEWEST`` words match whole only, and longer ones need the score of that many words beside the share. Null ids come out as null; repeated rows and items are judged each.
    Documents without leaks give no row; an empty benchmark gives none at all.
    """
    spark = docs.sparkSession
    kind = column_type(docs, id_col)
    schema = f"{id_col} {kind}, {item_col} long, score double, first_word long, end_word long"
    out = spark.createDataFrame([], schema)
    for ids, items in _item_blocks(benchmark, item_col, text):
        sent = spark.sparkContext.broadcast((ids, _seeded(docs, items, text, least)))

        def run(batches, sent=sent):
            names, grams = sent.value
            for batch in slices(batches):
                found = [(row, *leak) for row, t in enumerate(byte_texts(batch, text))
                         for leak in grams.leaks(hashed_words(lower_ascii(t), WORD_BYTE)[0])]
                rows = pa.array([f[0] for f in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(id_col).take(rows), pa.array([names[f[1]] for f in found], pa.int64()),
                     pa.array([f[2] for f in found], pa.float64()), pa.array([f[3] for f in found], pa.int64()),
                     pa.array([f[4] for f in found], pa.int64())],
                    names=[id_col, item_col, "score", "first_word", "end_word"])

        out = out.unionByName(map_arrow(docs.select(id_col, text), run, schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, item_col: str = "item_id", text: str = "text",
               least: float = LEAST) -> DataFrame:
    """The rows of ``docs`` that hold no copy of a test item, all columns as they are."""
    spark = docs.sparkSession
    out = docs
    for _, items in _item_blocks(benchmark, item_col, text):
        sent = spark.sparkContext.broadcast(_seeded(docs, items, text, least))

        def run(batches, sent=sent):
            for batch in slices(batches):
                clean = [not sent.value.leaks(hashed_words(lower_ascii(t), WORD_BYTE)[0])
                         for t in byte_texts(batch, text)]
                yield batch.filter(pa.array(clean, pa.bool_()))

        out = map_arrow(out, run, docs.schema)
    return out
