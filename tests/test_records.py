"""CSV records whose quoted fields span lines and splits, against Python's csv reader."""

import csv
import io
import os
import random

import pytest
from pyspark.sql import functions as F

from conftest import rows
from quarry.plans import books
from quarry.sources import preamble as PR
from quarry.sources.records import line_effect, records


def _write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


def _read(spark, path, split_bytes):
    kept = PR.strip_preamble(PR.lines_from_files(spark, path, split_bytes), ["h1,h2"])
    return PR.parse_csv_lines(records(kept)).select("h1", "h2", "h3")


def _python(text):
    body = text[text.index("h1,h2"):]
    body = "\n".join(line for line in body.split("\n") if line.strip())
    return [tuple(x if x else None for x in r) for r in list(csv.reader(io.StringIO(body)))[1:]]


def _key(row):
    return tuple(map(str, row))


@pytest.mark.parametrize("split_bytes", [7, 40, 1 << 20])
def test_records_equal_the_csv_reader(spark, tmp_dir, split_bytes):
    rng = random.Random(split_bytes)
    cells = ["plain", "", 'say "hi"', "two\nlines", 'a,b\n"c",\n\nd', '5" pipe', "x" * 50, "\n\n", "é\n日本", '"']

    def field():
        cell = rng.choice(cells)
        return '"' + cell.replace('"', '""') + '"' if any(c in cell for c in ',\n"') and cell != '5" pipe' else cell
    lines = [",".join(field() for _ in range(3)) for _ in range(60)]
    text = 'a "stray quote\n\nmore,"\nh1,h2,h3\n' + "\n\n".join(lines) + "\n"
    path = _write(tmp_dir, f"r{split_bytes}.csv", text)
    # Blank lines go before records are read, also inside quotes.
    got = sorted((tuple(r) for r in _read(spark, path, split_bytes).collect()), key=_key)
    assert got == sorted(_python(text), key=_key)


def test_a_record_over_many_splits(spark, tmp_dir):
    long = "\n".join(f"line {i} with, commas and ""quotes""" for i in range(400))
    text = f'h1,h2,h3\n1,"{long}",x\n2,y,z\n'
    path = _write(tmp_dir, "long.csv", text)
    lines = PR.lines_from_files(spark, path, 64)
    assert lines.select("pos.__blk").distinct().count() > 100
    got = {r.h1: r for r in _read(spark, path, 64).collect()}
    assert got["1"].h2 == long and got["1"].h3 == "x" and got["2"].h2 == "y"


@pytest.mark.parametrize("tail", ['2,"open\n3,x,y\n', '"'])
def test_an_unclosed_quote_raises(spark, tmp_dir, tail):
    path = _write(tmp_dir, "open.csv", "h1,h2,h3\n1,a,b\n" + tail)
    with pytest.raises(Exception, match="quoted field without an end"):
        _read(spark, path, 8).collect()


def test_a_record_beyond_the_limit_raises(spark, tmp_dir):
    path = _write(tmp_dir, "big.csv", 'h1,h2,h3\n1,"' + "word\n" * 100 + '",b\n')
    kept = PR.strip_preamble(PR.lines_from_files(spark, path), ["h1,h2"])
    with pytest.raises(Exception, match="record too long"):
        records(kept, max_bytes=200).collect()


def test_line_effects(spark):
    cases = {"a,b": (None, 0), 'a,"b"': (None, 1 - 1), 'a,"b': (1, 0), 'b",c': (0, 0), '"': (None, 1), '""': (None, 0),
             '5" pipe,x': (0, 0), 'a"b': (0, 0), '","': (None, 0)}
    df = spark.createDataFrame([(k,) for k in cases], "line string")
    fixed, swap = line_effect(F.col("line"))
    got = {r.line: (r.fixed, r.swap) for r in df.select("line", fixed.alias("fixed"), swap.alias("swap")).collect()}

    def after(text, inside):  # a plain state machine
        state = "quoted" if inside else "start"
        for i, c in enumerate(text):
            if state == "quoted":
                state = "closing" if c == '"' else state
            elif state == "closing":
                state = "quoted" if c == '"' else "start" if c == "," else "plain"
            elif state == "start":
                state = "quoted" if c == '"' else "start" if c == "," else "plain"
            elif c == ",":
                state = "start"
        return int(state == "quoted")
    for line, (fixed_state, swaps) in got.items():
        ends = after(line, False), after(line, True)
        assert ends == ((fixed_state,) * 2 if fixed_state is not None else (swaps, 1 - swaps)), line


def test_no_file_is_read_in_one_task(spark, tmp_dir):
    path = _write(tmp_dir, "index-2023.csv", 'Title,Author,Year\nA,"x\ny",2023\nB,z,2024\n' * 1)
    frame = books.read_indexes(spark, [path], split_bytes=16)[0]
    assert rows(frame, "Title", "Author") == [("A", "x\ny"), ("B", "z")]
    empty = _write(tmp_dir, "index-2024.csv", "Title,Author,Year\n")
    assert books.read_indexes(spark, [empty])[0].count() == 0
