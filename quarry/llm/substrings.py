"""Substring dedup: documents stream against suffix automata of reference shards, and maximal
spans of windows that start earlier in the corpus are removed.

A window is a run of consecutive words. Of the short runs (grams) in a window the one of the least
hash marks it, so equal windows carry equal marks, and only windows whose mark occurs again in
the corpus can be repeated. A mark's first document is the reference of all windows that carry
it: the stretches of that document go into the automaton of its shard, and the stretches of all
documents with such marks stream through it. A window that its mark's first document lacks is
asked again in the next round, now under its own hash, whose first document has it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.automaton import SuffixAutomaton
from quarry.llm.common import (NOT_SPACE, byte_texts, checkpointed, column_type, drop_written, give_back, hinted,
                               map_arrow, slices, to_python, written)
from quarry.llm.wordhash import hashed_words, run_hashes

WINDOW, GRAM = 20, 6
#: Reference words of an automaton, and words that one task streams through it.
SHARD_WORDS, STREAM_WORDS = 25_000, 200_000
#: Marks that are broadcast at most, and bytes of a broadcast in Spark's own form. The driver holds
#: one several times over: as collected, as a hash table that doubles as it grows, and as sent.
HOT, BROADCAST_BYTES = 4_096, 40 << 20
#: What a document takes there beside each of its stretches, and beside each number of its spans. All
#: are flat arrays: a nested row takes eight bytes a field and sixteen more.
PART_ROW, PART, SPAN_ROW, NUMBER = 80, 24, 112, 4


def marks(words: np.ndarray, window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of all grams, place of the marking gram of every window): the first of the least
    hash, from leasts over runs of twice the length each time."""
    grams = run_hashes(words, gram)
    span = window - gram + 1
    if len(grams) < span:
        return grams, np.zeros(0, np.int64)
    least, place, size = grams, np.arange(len(grams)), 1
    while size < span:
        step = min(size, span - size)
        later = least[step:] < least[:-step]
        place = np.where(later, place[step:], place[:-step])
        least = np.where(later, least[step:], least[:-step])
        size += step
    return grams, place


def _marked(docs: DataFrame, window: int) -> DataFrame:
    """(mark, doc, place): the marking grams of every document that has an id."""
    def run(batches):
        for batch in slices(batches):
            texts = byte_texts(batch, "text")
            words, starts, _ = hashed_words(b" ".join(texts), NOT_SPACE)  # of all texts, hashed at once
            begins = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
            edges = np.searchsorted(starts, begins)
            row = np.repeat(np.arange(len(texts)), np.diff(edges))
            grams, at = marks(words, window)
            at = np.unique(at[row[:len(at)] == row[window - 1:]]) if len(at) else at  # windows of one text
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams[at].view(np.int64)), batch.column("doc").take(pa.array(row[at])),
                 pa.array((at - edges[row[at]]).astype(np.int32))],
                names=["mark", "doc", "place"])

    return map_arrow(docs.filter(F.col("doc").isNotNull()).select("doc", "text"), run, "mark long, doc long, place int")


def _stretches(found: DataFrame, gap: int, before: int, after: int) -> DataFrame:
    """(doc, first, lo, hi, start, stop) of neighbouring places of ``found`` (mark, doc, place)
    whose mark occurs again, with the mark's first document. ``lo``..``hi`` are the places and
    start..stop the words around them. A mark is counted in the tasks before the shuffle. Marks
    that hold more than a 4,096th of all places, hence fewer than ``HOT`` of them, are broadcast to
    their places, which so need no shuffle by the mark; all others are joined by one."""
    again = found.groupBy("mark").agg(F.count("*").alias("n"), F.min("doc").alias("first")).filter("n > 1")
    hot = F.col("n") > max(1, found.count() // HOT)
    often = F.broadcast(again.filter(hot).select("mark", "first"))
    rest = found.join(often.select("mark"), "mark", "left_anti").join(again.filter(~hot).select("mark", "first"), "mark")
    known = found.join(often, "mark").unionByName(rest)
    order = Window.partitionBy("doc").orderBy("place")
    breaks = (F.lag("first").over(order).isNull() | (F.lag("first").over(order) != F.col("first"))
              | (F.col("place") - F.lag("place").over(order) > gap))
    return (known.select("doc", "place", "first").distinct()
            .withColumn("fresh", breaks.cast("int"))
            .withColumn("run", F.sum("fresh").over(order))
            .groupBy("doc", "run", "first").agg(F.min("place").alias("lo"), F.max("place").alias("hi"))
            .select("doc", "first", "lo", "hi", F.greatest(F.col("lo") - before, F.lit(0)).alias("start"),
                    (F.col("hi") + after).alias("stop")))


def _dealt(stretches: DataFrame) -> DataFrame:
    """Stretches with their first document's shard and the number of tasks that share it, by the
    words to stream: a passage that a third of all documents hold is streamed by many tasks, each
    with a copy of the shard's automaton."""
    size = (F.col("stop") - F.col("start")).cast("long")
    own = F.col("doc") == F.col("first")
    words = stretches.agg(F.sum(F.when(own, size))).first()[0] or 0
    shards = max(1, -(-words // SHARD_WORDS))
    rows = stretches.withColumn("shard", F.pmod(F.xxhash64("first"), F.lit(shards)).cast("int"))
    tasks = rows.groupBy("shard").agg(F.ceil(F.sum(size) / STREAM_WORDS).cast("int").alias("tasks"))
    return rows.join(hinted(checkpointed(tasks), 48), "shard")


def _flat(column: str, *fields: str) -> Column:
    """An array of structs as one array of the fields' numbers, struct by struct."""
    return F.flatten(F.transform(column, lambda x: F.array(*[x[f].cast("int") for f in fields])))


def _bounded(df: DataFrame, numbers: str, row: int, number: int) -> DataFrame:
    """``df`` (checkpointed) marked for a broadcast if its rows and the numbers in that array column
    take at most ``BROADCAST_BYTES``, else unchanged: both sides are shuffled then."""
    rows, n = df.agg(F.count("*"), F.sum(F.size(numbers).cast("long"))).first()
    return F.broadcast(df) if rows * row + (n or 0) * number <= BROADCAST_BYTES else df


def _parts_by_doc(dealt: DataFrame) -> DataFrame:
    """(doc, firsts, numbers) of each document's stretches: their first documents, and lo, hi, shard
    and tasks of each in a line."""
    parts = dealt.groupBy("doc").agg(F.collect_list(F.struct("first", "lo", "hi", "shard", "tasks")).alias("parts"))
    return parts.select("doc", F.col("parts.first").alias("firsts"), _flat("parts", "lo", "hi", "shard", "tasks").alias("numbers"))


def _texts(docs: DataFrame, dealt: DataFrame, before: int, after: int) -> DataFrame:
    """The words of all stretches, ``before`` and ``after`` their places: a row for the task that
    streams it, and rows for all tasks of the shard if it belongs to the reference."""
    hint = _bounded(checkpointed(_parts_by_doc(dealt)), "firsts", PART_ROW, PART)
    schema = ("shard int, task int, reference boolean, doc long, version long, first long, lo int, hi int, "
              "start int, words string")

    def run(batches):
        for batch in slices(batches):
            rows = []
            for doc, version, text, firsts, numbers in zip(*(batch.column(c).to_pylist() for c in
                                                             ("doc", "version", "text", "firsts", "numbers"))):
                words = (text or "").encode().split()
                for first, lo, hi, shard, tasks in zip(firsts, *(numbers[i::4] for i in range(4))):
                    start = max(lo - before, 0)
                    if start >= len(words):
                        continue
                    row = (doc, version, first, lo, hi, start, b" ".join(words[start:hi + after]).decode())
                    rows.append((shard, doc % tasks, False, *row))
                    if doc == first:
                        rows += [(shard, t, True, *row) for t in range(tasks)]
            cols = list(zip(*rows)) if rows else [()] * 10
            kinds = [pa.int32(), pa.int32(), pa.bool_(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(),
                     pa.int32(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=[x.split()[0] for x in schema.split(", ")])

    return map_arrow(docs.filter(F.col("doc").isNotNull()).join(hint, "doc"), run, schema)


def _pieces(references: list[tuple], window: int):
    """The references in lists of about ``SHARD_WORDS`` words; longer ones are cut with an overlap
    of a window less one word, so that no window is lost."""
    piece, size = [], 0
    for doc, version, start, ids in references:
        lo = 0
        while lo == 0 or lo + window <= len(ids):
            part = ids[lo:lo + SHARD_WORDS]
            if piece and size + len(part) > SHARD_WORDS:
                yield piece
                piece, size = [], 0
            piece.append((doc, version, start + lo, part))
            size += len(part)
            lo += SHARD_WORDS - window + 1
    if piece:
        yield piece


def _numbered(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(numbers of the words of all texts, where each text's begin and the count of all, a hash of
    each numbered word)."""
    lists = pc.split_pattern(texts.cast(pa.large_string()).combine_chunks(), " ")
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(zero_copy_only=False)))).astype(np.int64)
    words = lists.flatten().dictionary_encode()
    hashes = [hashed_words(w, NOT_SPACE)[0] for w in
              (b" ".join(part.to_pylist()) for part in _parts(words.dictionary.cast(pa.large_binary())))]
    return words.indices.to_numpy(), bounds, np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)


def _parts(values: pa.Array, rows: int = 1 << 16):
    for lo in range(0, len(values), rows):
        yield values.slice(lo, rows)


def match_shard(rows: pa.Table, window: int, by_marks: bool, salt: int) -> pa.Table:
    """(doc, version, start, stop, hash) rows of one shard and task: spans to remove (hash null),
    and windows to ask again (stop null). All references go in by document and place, so an
    automaton's first occurrence is the earliest. Places are those of all rows' words in a line."""
    rows = rows.sort_by([(c, "ascending") for c in ("doc", "version", "start")])
    numbers, bounds, hashes = _numbered(rows.column("words"))
    spelled = numbers.tolist()
    begins, ends = bounds[:-1].tolist(), bounds[1:].tolist()
    doc, version, start, mine, lo, hi = (rows.column(c).to_numpy() for c in ("doc", "version", "start", "first", "lo", "hi"))
    is_reference = rows.column("reference").to_numpy()
    references = [(int(doc[i]), int(version[i]), int(start[i]), spelled[begins[i]:ends[i]])
                  for i in np.flatnonzero(is_reference).tolist()]
    streamed = np.flatnonzero(~is_reference)
    versions: dict[int, set] = {}
    for d, v, _, _ in references:
        versions.setdefault(d, set()).add(v)
    several = {d for d, v in versions.items() if len(v) > 1}
    row = np.repeat(np.arange(len(doc)), np.diff(bounds))
    place = start[row] + np.arange(len(row)) - bounds[row]  # in the row's document
    one = ~np.isin(doc, list(several))
    earlier, settled = np.zeros(len(row), bool), np.zeros(len(row), bool)  # by the window's last word
    for piece in _pieces(references, window):
        automaton, bases = SuffixAutomaton(), []
        for _, _, _, ids in piece:
            bases.append(automaton.size)
            automaton.add(ids)
        piece_doc, piece_start = np.array([p[0] for p in piece]), np.array([p[2] for p in piece])
        bases = np.array(bases)
        for i in streamed.tolist():
            found = np.array(automaton.first_ends(spelled[begins[i]:ends[i]], window), np.int64)
            at = np.flatnonzero(found >= 0)
            if not len(at):
                continue
            found, at = found[at], at + begins[i]
            r = np.searchsorted(bases, found, "right") - 1
            earlier[at[piece_doc[r] < doc[i]]] = True
            own = piece_doc[r] == doc[i]
            if one[i]:
                earlier[at[own & (piece_start[r] + found - bases[r] < place[at])]] = True
            if mine[i] == doc[i]:  # else it is here for another mark's sake
                settled[at[own]] = True
    seen: dict[tuple, dict[tuple, int]] = {}
    for i in streamed[~one[streamed]].tolist():  # rows that share an id: each is compared with itself
        own = seen.setdefault((int(doc[i]), int(version[i])), {})
        for at in range(begins[i] + window - 1, ends[i]):
            first = own.setdefault(tuple(spelled[at - window + 1:at + 1]), int(place[at]))
            earlier[at] |= first < place[at]
    ends_at = np.flatnonzero(earlier)
    fresh = np.ones(len(ends_at), bool)
    fresh[1:] = (np.diff(ends_at) > window) | (np.diff(row[ends_at]) > 0)
    a, b = ends_at[fresh], ends_at[np.append(fresh[1:], True)[:len(fresh)]]
    spans = (doc[row[a]], version[row[a]], place[a] - window + 1, place[b] + 1, None)
    open_ = ~(earlier | settled) & ~is_reference[row] & (np.arange(len(row)) - bounds[row] >= window - 1)
    at = np.flatnonzero(open_) - window + 1  # first words
    if len(at):
        words = hashes[numbers]
        if by_marks:
            marked = place[marks(words, window)[1][at]]
            at = at[(marked >= lo[row[at]]) & (marked <= hi[row[at]])]
        wide = run_hashes(words, window, salt).view(np.int64)[at]
    else:
        wide = np.zeros(0, np.int64)
    again = (doc[row[at]], version[row[at]], place[at], None, wide)
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64())
    return pa.concat_tables(
        pa.Table.from_arrays([pa.nulls(len(part[0]), k) if c is None else pa.array(c).cast(k) for c, k in zip(part, kinds)],
                             names=["doc", "version", "start", "stop", "hash"]) for part in (spans, again))


def _matched(texts: DataFrame, window: int, by_marks: bool, salt: int) -> DataFrame:
    to_python(texts.sparkSession)

    def run(rows: pa.Table) -> pa.Table:
        out = match_shard(rows, window, by_marks, salt)
        give_back()
        return out

    return texts.groupBy("shard", "task").applyInArrow(run, "doc long, version long, start int, stop int, hash long")


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc, version, spans array<struct<start,stop>>): for each document with repeated windows
    the words (from 0) that they cover; ``version`` is the text's hash.

    A window counts as repeated if its words also stand in a document of a smaller id, or earlier
    in the same row. Rows that share an id are none of each other's earlier documents. Rows with
    a null id are left out here (see :func:`remove_repeats`).
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text).alias("text"))
    full = rows.withColumn("version", F.xxhash64("text"))
    found, path = written(_marked(rows, window), "marks")
    # marks of neighbouring windows are at most a window apart
    around = (window - GRAM, window)
    stretches = checkpointed(_stretches(found, window, *around))
    drop_written(spark, path)
    spans, round_ = None, 0
    while not stretches.isEmpty():
        matched = checkpointed(_matched(_texts(full, _dealt(stretches), *around), window, round_ == 0, round_))
        now = matched.filter("stop is not null").select("doc", "version", "start", "stop")
        spans = now if spans is None else spans.unionByName(now)
        again = matched.filter("hash is not null").select(F.col("hash").alias("mark"), "doc",
                                                          F.col("start").alias("place")).distinct()
        around = (0, window)
        stretches = checkpointed(_stretches(again, 1, *around))
        round_ += 1
    if spans is None:
        spans = spark.createDataFrame([], "doc long, version long, start int, stop int")
    return spans.distinct().groupBy("doc", "version").agg(F.sort_array(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def own_repeats(words: list, window: int) -> list[tuple[int, int]]:
    """Spans of windows that stand earlier in the same text, by an automaton of it."""
    automaton = SuffixAutomaton()
    automaton.add(words)
    return [(at - window + 1, at + 1) for at, end in enumerate(automaton.first_ends(words, window)) if 0 <= end < at]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                   keep: tuple[str, ...] = (), prefix: str = "") -> DataFrame:
    """(id, ``keep`` columns, n_words, n_removed, kept, spans) for every row of ``docs``; ``prefix``
    goes before the last four names, for tables that have such columns.

    ``kept`` has the words ``[^\\x20\\x09-\\x0D]+`` outside repeated windows, joined by one space;
    ``spans`` are the maximal removed runs of words. Windows are judged on the input, so an
    earlier copy that is removed itself still counts. A row with a null id loses only windows
    that stand earlier in itself, and is nobody's earlier document; identical rows (id and text)
    have identical results; rows that share an id but not the text don't touch each other. Null
    and empty texts have no words. Whole texts are read.
    """
    found = repeated_spans(docs, id_col, text, window)
    spans = checkpointed(found.select(F.col("doc").alias("_doc"), F.col("version").alias("_version"),
                                      _flat("spans", "start", "stop").alias("_spans")))
    carried = list(dict.fromkeys([id_col, *keep]))
    made = [prefix + c for c in ("n_words", "n_removed", "kept", "spans")]
    source = text if text in carried else "_text"
    rows = docs.select(*carried, *([] if text in carried else [F.col(text).alias(source)]), F.col(id_col).cast("long").alias("_doc"),
                       F.xxhash64(text).alias("_version"))
    joined = rows.join(_bounded(spans, "_spans", SPAN_ROW, NUMBER), ["_doc", "_version"], "left")
    kinds = ", ".join(f"`{c}` {column_type(docs, c)}" for c in carried)

    def run(batches):
        for batch in slices(batches):
            out = []
            for doc, raw, parts in zip(batch.column("_doc").to_pylist(), byte_texts(batch, source),
                                       batch.column("_spans").to_pylist()):
                words = raw.split()
                if doc is None:
                    pairs = own_repeats(words, window)
                else:
                    pairs = list(zip(parts[0::2], parts[1::2])) if parts else []
                n, merged = len(words), []
                for a, b in sorted(pairs):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                for a, b in reversed(merged):
                    del words[a:b]
                out.append((n, n - len(words), b" ".join(words).decode(),
                            [{"start": a, "stop": b} for a, b in merged]))
            cols = list(zip(*out)) if out else [()] * 4
            spans_kind = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))
            kinds = [pa.int64(), pa.int64(), pa.string(), spans_kind]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried],
                                              *[pa.array(c, k) for c, k in zip(cols, kinds)]], names=[*carried, *made])

    types = ("long", "long", "string", "array<struct<start:long,stop:long>>")
    return map_arrow(joined, run, ", ".join([kinds, *[f"`{c}` {t}" for c, t in zip(made, types)]]))


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text: str = "text", window: int = WINDOW,
                length: str = "n_chars") -> DataFrame:
    """``docs`` with the repeated spans cut from its texts: what is left of a touched text is its
    words joined by one space, and its ``length`` column, if there is one, is counted anew.
    Untouched texts stay as they are. Every row is kept, see :func:`remove_repeats`."""
    cut = remove_repeats(docs, id_col, text, window, tuple(docs.columns), "_cut_")
    touched = F.col("_cut_n_removed") > 0
    new = {text: F.when(touched, F.col("_cut_kept")).otherwise(F.col(text))}
    if length in docs.columns:
        counted = F.length("_cut_kept").cast(column_type(docs, length))
        new[length] = F.when(touched, counted).otherwise(F.col(length))
    return cut.withColumns(new).select(*docs.columns)
