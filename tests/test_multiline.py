"""Line breaks inside quotes, over splits of any size, against a reader that goes character by character."""

import random
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from regispark.sources import multiline
from regispark.sources.archives import scan_archives
from regispark.sources.delimited import CORRUPT, scan, split_corrupt

NAMES = ["a", "b"]
SPLIT = "spark.sql.files.maxPartitionBytes"
PIECES = ["x", "y z", ";", '"', '""', "\n", "\n", "\r\n", '"\n', '\n"', ';"', '";', "é", "\x00"]


def plain_records(text, file=True):
    """Records without their line ends, one character after the other."""
    text = text.replace("\x00", "")
    out, held, at_start, quoted = [], "", True, False
    i = 0
    while i < len(text):
        c = text[i]
        if quoted:
            if c == '"':
                if text[i + 1 : i + 2] == '"':
                    held += c
                    i += 1
                else:
                    quoted = False
            held += c
        elif c == "\n":
            out.append(held)
            held, at_start = "", True
            i += 1
            continue
        else:
            if c == '"' and at_start:
                quoted = True
            at_start = c == ";"
            held += c
        at_start = at_start and not quoted
        i += 1
    if held:  # of an unclosed record, the last line end is the file's
        out.append(held.removesuffix("\n") if file else held)
    return out


@pytest.fixture
def small_splits(spark):
    def at(size):
        spark.conf.set(SPLIT, size)

    yield at
    spark.conf.unset(SPLIT)


def whole_records(spark, path):
    lines = multiline.read_lines(spark, path, None)
    text = F.replace(F.decode(F.col("value").cast("binary"), "ISO-8859-1"), F.lit("\x00"), F.lit(""))
    return sorted(r["value"] for r in multiline.records(lines, text, file="_file").collect())


@pytest.mark.parametrize("seed", range(3))
def test_records_of_any_text_over_any_split(spark, tmp_path, small_splits, seed):
    draw = random.Random(seed)
    want = []
    for k in range(6):
        text = "".join(draw.choice(PIECES) for _ in range(draw.randrange(1, 80)))
        if draw.random() < 0.7:
            text += "\n"
        (tmp_path / f"{k}.csv").write_bytes(text.encode("latin-1"))
        want += plain_records(text)
    small_splits(str([19, 60, 200][seed]))
    assert whole_records(spark, str(tmp_path)) == sorted(want)


@pytest.mark.parametrize("seed", range(200))
def test_records_of_a_block(seed):
    draw = random.Random(seed)
    text = "".join(draw.choice(PIECES) for _ in range(draw.randrange(0, 60)))
    data = text.encode("latin-1").replace(b"\x00", b"")
    got = [r.decode("latin-1") for r in multiline.records_of(data)]
    assert [r for r in got if r] == [r for r in plain_records(text, file=False) if r]
    size = multiline.closed_length(data)
    assert size == 0 or data[:size].endswith(b"\n")
    assert [r.decode("latin-1") for r in multiline.records_of(data[:size])] == got[: len(multiline.records_of(data[:size]))]


def test_states_compose():
    draw = random.Random(1)
    for _ in range(50):
        out, in_ = (np.array([draw.random() < 0.5 for _ in range(30)]) for _ in range(2))
        for first in (False, True):
            state, want = first, []
            for o, i in zip(out, in_):
                state = bool(i if state else o)
                want.append(state)
            assert multiline.states(out, in_, first).tolist() == want


def test_a_large_file_is_read_by_many_tasks(spark, tmp_path, small_splits):
    record = '{k};"first line\nsecond ""line"";\nthird"\n'
    (tmp_path / "f.csv").write_text("".join(record.format(k=k) for k in range(60_000)), newline="")
    small_splits("200k")
    rows = scan(spark, str(tmp_path), NAMES, multiline=True)
    assert rows.rdd.getNumPartitions() >= 10
    assert rows.count() == 60_000
    assert rows.select("b").distinct().collect()[0][0] == 'first line\nsecond "line";\nthird'
    assert rows.agg(F.sum(F.col("a").cast("bigint"))).first()[0] == sum(range(60_000))


def test_nul_goes_before_parsing_on_all_paths(spark, tmp_path):
    data = b'1;\x00"a;b"\n2;"c\x00\nd"\r\n'
    (tmp_path / "f.csv").write_bytes(data)
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as archive:
        archive.writestr("F", data)
    want = [("1", "a;b"), ("2", "c\nd")]
    read = scan(spark, str(tmp_path), NAMES, multiline=True, glob="*.csv")
    assert sorted(map(tuple, read.collect())) == want
    assert sorted(map(tuple, scan_archives(spark, str(tmp_path), NAMES, multiline=True).collect())) == want
    (tmp_path / "g.csv").write_bytes(b'1;\x00"a;b"\n')
    for several in (False, True):
        assert [tuple(r) for r in scan(spark, str(tmp_path / "g.csv"), NAMES, multiline=several).collect()] == [("1", "a;b")]


@pytest.mark.parametrize("block", [64, 1 << 20])
def test_archived_records_longer_than_a_block(spark, tmp_path, monkeypatch, block):
    from regispark.sources import archives

    monkeypatch.setattr(archives, "BLOCK_BYTES", block)
    draw = random.Random(block)
    text = "".join(f'{k};"' + "line\n" * draw.randrange(0, 60) + '"\n' for k in range(200))
    with zipfile.ZipFile(tmp_path / "f.zip", "w") as archive:
        archive.writestr("F", text)
    blocks = list(archives._whole_records(zipfile.ZipFile(tmp_path / "f.zip").open("F")))
    assert b"".join(blocks).decode() == text and (len(blocks) > 20) == (block == 64)
    read = scan_archives(spark, str(tmp_path), NAMES, multiline=True)
    assert read.count() == 200 and read.agg(F.sum(F.length("b"))).first()[0] == text.count("line\n") * 5


def test_bad_records(spark, tmp_path, small_splits, monkeypatch):
    (tmp_path / "f.csv").write_bytes(b'1;"a\nb"\n2\n3;x;y\n\n4;"no\nend\n')
    good, bad = split_corrupt(scan(spark, str(tmp_path), NAMES, multiline=True, on_error="quarantine"))
    assert sorted(map(tuple, good.collect())) == [("1", "a\nb"), ("4", "no\nend")]
    assert sorted(r[CORRUPT] for r in bad.collect()) == ["2", "3;x;y"]
    with pytest.raises(Exception, match="(?i)malformed"):
        scan(spark, str(tmp_path), NAMES, multiline=True).collect()
    small_splits("40")
    (tmp_path / "f.csv").write_bytes(b'1;x\n2;"' + b"line\n" * 30 + b'"\n3;y\n')
    lines = multiline.read_lines(spark, str(tmp_path), None)
    told = multiline.records(lines, F.col("value"), file="_file", on_error="quarantine", limit=50).collect()
    assert sorted((r["value"], r["whole"]) for r in told if r["whole"]) == [("1;x", True), ("3;y", True)]
    (long,) = [r["value"] for r in told if not r["whole"]]
    assert "more than 50 characters" in long and "f.csv" in long
    with pytest.raises(Exception, match="more than 50 characters"):
        multiline.records(lines, F.col("value"), file="_file", limit=50).collect()
