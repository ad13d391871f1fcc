import io
import json
import re
import time

import pytest
from pyspark.sql import functions as F

from payloads import coin
from tidemark.plans.silver import to_silver
from tidemark.sources import documents as scan
from tidemark.sources.bronze import read_bronze
from tidemark.sources.documents import documents_in, ranges, read_documents

# What a reader of whole files does: split where a bracket closes, a line ends and a bracket opens.
WHOLE = re.compile(rb"(?<=\})\s*\n\s*(?=\{)")

FILES = [
    b'{"a":1}\n{"b":2}\n',
    b'\n \n{\n "a": {"x": 1},\n "b": [{\n}, {\n}]\n}\n\n  {"c": "} {"}\r\n\t\n{ }',
    b'{"a":1} {"b":2}\n{"c":3}\n\n\n',
    b'[1,\n2]', b"", b"\n\n", b'{"a":1}' + b" \n" * 40 + b'{"b":2}',
    '{"é":"日本"}\n{"ü":"\U0001f600"}\n'.encode(),
    b'not json\n{"a":1}\n}\n{"b"',
]


def whole(data):
    return [d.strip() for d in WHOLE.split(data) if d.strip()]


@pytest.mark.parametrize("data", FILES)
def test_borders_at_every_byte(data, monkeypatch):
    for chunk in (1, 3, 1 << 20):
        monkeypatch.setattr(scan, "CHUNK", chunk)
        for cut in range(len(data) + 1):
            parts = [list(documents_in(io.BytesIO(data), a, b)) for a, b in ((0, cut), (cut, len(data))) if a < b]
            found = [d for part in parts for d in part]
            assert [d.strip() for _, d in found] == whole(data), (chunk, cut)
            assert all(data[at:].startswith(d) for at, d in found)


def test_small_ranges_over_a_file(monkeypatch):
    monkeypatch.setattr(scan, "CHUNK", 7)
    data = b"\n".join(json.dumps({"n": i, "o": {"p": [{}, {}]}}, indent=i % 3).encode() for i in range(60))
    for size in range(1, 120, 7):
        found = [d for a in range(0, len(data), size) for d in documents_in(io.BytesIO(data), a, min(len(data), a + size))]
        assert [json.loads(d)["n"] for _, d in found] == list(range(60))


def test_a_long_document_is_searched_once():
    """Chunks are not searched again and again: 40 MB without a border, and as much white space."""
    data = b'{"a":"' + b"x" * 40_000_000 + b'"}\n' + b" " * 20_000_000 + b'{"b":1}'
    assert [len(d) for _, d in documents_in(io.BytesIO(data), 0, len(data))] == [40_000_008, 7]
    assert [d for _, d in documents_in(io.BytesIO(data), 50_000_000, len(data))] == [b'{"b":1}']


def test_small_files_share_a_task():
    files = [(f"f{i}", 10) for i in range(7)] + [("large", 95)]
    tasks = ranges(files, 30)
    assert [t for task in tasks for t in task][-4:] == [("large", a, min(95, a + 30)) for a in (0, 30, 60, 90)]
    assert all(sum(b - a for _, a, b in task) <= 30 for task in tasks) and len(tasks) == 7
    assert ranges([], 30) == []


def document(day, *coins):
    return {
        "source": "coingecko", "logical_date": f"{day}T00:00:00+00:00", "fetched_at": f"{day}T01:00:00+00:00",
        "page_count": 1, "pages": [{"coins": list(coins)}],
    }


def test_one_large_file_is_read_by_several_tasks(spark, tmp_path):
    made = [document("2031-01-01", coin(f"c{i}", float(i))) for i in range(500)]
    (tmp_path / "all.json").write_text("\n".join(json.dumps(d, indent=2) for d in made))
    (tmp_path / "_ignored.json").write_text("{}")
    rows = read_documents(spark, str(tmp_path), range_bytes=8_000)
    tasks = rows.groupBy(F.spark_partition_id()).count().collect()
    assert len(tasks) > 10 and sum(t["count"] for t in tasks) == 500
    got = read_bronze(spark, "coingecko", str(tmp_path), range_bytes=8_000)
    assert sorted(r["pages"][0]["coins"][0]["id"] for r in got.collect()) == sorted(f"c{i}" for i in range(500))


def test_folders_globs_lists_and_nothing(spark, tmp_path):
    for feed in ("coingecko", "newsapi"):
        folder = tmp_path / f"feed={feed}" / "day=2031-01-01"
        folder.mkdir(parents=True)
        (folder / "a.json").write_text(json.dumps(document("2031-01-01", coin(feed, 1.0))))
    (tmp_path / "empty").mkdir()
    assert read_documents(spark, f"{tmp_path}", "coingecko").count() == 1
    assert read_documents(spark, f"{tmp_path}/feed=*/day=*/*.json").count() == 2
    assert read_documents(spark, [f"{tmp_path}/feed=newsapi", f"{tmp_path}/feed=coingecko"]).count() == 2
    assert read_documents(spark, f"{tmp_path}/empty").collect() == []
    assert read_documents(spark, f"{tmp_path}/absent*").collect() == []


def test_many_small_documents_are_not_copied_on(monkeypatch):
    """What is left of a chunk isn't copied for each document: 80,000 of them in a chunk of 8 MB."""
    monkeypatch.setattr(scan, "CHUNK", 8 << 20)
    one = b'{"a":"' + b"x" * 90 + b'"}'
    data = b"\n".join([one] * 80_000)
    started = time.perf_counter()
    assert [(i, d) for i, d in documents_in(io.BytesIO(data), 0, len(data))] == [(i * (len(one) + 1), one) for i in range(80_000)]
    assert time.perf_counter() - started < 5


def test_a_document_is_parsed_once(spark, tmp_path, capsys):
    """Filters on what is in a document don't parse it again."""
    (tmp_path / "a.json").write_text(json.dumps(document("2031-01-01", coin("bitcoin", 1.0))) + "\nnot json\n{}\n")
    rows = to_silver(read_bronze(spark, "coingecko", str(tmp_path)), "coingecko")
    rows.explain()
    assert capsys.readouterr().out.count("from_json(") == 1
    assert [r["coin_id"] for r in rows.collect()] == ["bitcoin"]
