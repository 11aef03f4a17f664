import io
import json
import os
import zipfile

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from faultline.schemas import RAW_RECORD
from faultline.sources import partition_index, records, tables
from faultline.streaming.landing import land_archives, read_bronze


def write_zip(path, **members):
    path.parent.mkdir(parents=True, exist_ok=True)
    with zipfile.ZipFile(path, "w") as archive:
        for name, content in members.items():
            archive.writestr(name.replace("__", "."), content if isinstance(content, str) else json.dumps(content))


def cut(text, chunk, bare_object=False, monkeypatch=None):
    monkeypatch.setattr(records, "_CHUNK", chunk)
    return [json.loads(r) for r in records._records(io.BytesIO(text.encode()), bare_object)]


@pytest.mark.parametrize("chunk", [1, 7, 64, 1 << 20])
def test_records_are_cut_out_of_documents(monkeypatch, chunk):
    items = [{"a": i, "t": "brackets ]}\"é𝒳 " * i, "n": {"x": [1, {"y": None}]}} for i in range(6)]
    for document in (
        json.dumps({"meta": {"results": {"total": 3}}, "results": items}),
        json.dumps({"results": items, "after": [1, 2]}, indent=2, ensure_ascii=False),
        json.dumps(items),
        "﻿" + json.dumps(items),
    ):
        assert cut(document, chunk, monkeypatch=monkeypatch) == items
    assert cut('{"meta": {}}', chunk, monkeypatch=monkeypatch) == []
    assert cut("[]", chunk, monkeypatch=monkeypatch) == []
    assert cut('{"results": []}', chunk, monkeypatch=monkeypatch) == []
    assert cut("12", chunk, monkeypatch=monkeypatch) == []
    assert cut('{"code": ["A", "B"], "name": ["x", "y"]}', chunk, True, monkeypatch) == [{"code": "A", "name": "x"}, {"code": "B", "name": "y"}]


def test_zip_scan(spark, tmp_path, rows):
    write_zip(tmp_path / "b.zip", data__json={"results": [{"k": 3}]}, notes__txt="no")
    write_zip(tmp_path / "a.zip", one__json={"meta": {}, "results": [{"k": 1}]}, two__json=[{"k": 2}], three__json={"meta": 1})
    found = records.scan_zips(spark, str(tmp_path))
    assert found.schema == RAW_RECORD
    got = found.select(F.element_at(F.split("file", "/"), -1), "member", "pos", F.get_json_object("record", "$.k"))
    assert rows(got) == [("a.zip", 0, 0, "1"), ("a.zip", 1, 1, "2"), ("b.zip", 0, 0, "3")]


@pytest.mark.parametrize("zipped", [False, True])
def test_small_files_share_a_batch(zipped, monkeypatch):
    """Files of a few records go out together, large ones in parts; places stay those within the file."""
    monkeypatch.setattr(records, "_ROWS", 100)

    def content(n):
        document = json.dumps([{"k": k} for k in range(n)]).encode()
        if not zipped:
            return document
        with zipfile.ZipFile(packed := io.BytesIO(), "w") as archive:
            archive.writestr("data.json", document)
        return packed.getvalue()

    sizes = [2, 0, 1, 3] * 10 + [150]
    given = [pa.RecordBatch.from_pydict({"path": [str(i)], "content": [content(n)]}) for i, n in enumerate(sizes)]
    found = list(records._cut(iter(given), zipped, False))
    assert [b.num_rows for b in found] == [100, 100, 10]
    rows = [tuple(r.values()) for b in found for r in b.to_pylist()]
    assert rows == [(str(i), 0, k, json.dumps({"k": k})) for i, n in enumerate(sizes) for k in range(n)]


def test_missing_folder_gives_no_rows(spark, tmp_path):
    for found in (records.scan_zips(spark, str(tmp_path / "none")), records.scan_documents(spark, str(tmp_path), "recalls_*.json")):
        assert found.columns == RAW_RECORD.names and found.count() == 0
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        records.scan_single_document(spark, str(tmp_path / "none.json")).count()


def test_document_scan_goes_through_subfolders(spark, tmp_path, rows):
    for path, content in {"2023/recalls_2023.json": {"results": [{"k": 1}, {"k": 2}]}, "all/recalls_all.json": [{"k": 3}], "all/other.json": [{"k": 9}]}.items():
        (tmp_path / path).parent.mkdir(exist_ok=True)
        (tmp_path / path).write_text(json.dumps(content))
    found = records.scan_documents(spark, str(tmp_path), "recalls_*.json")
    assert rows(found.select("pos", F.get_json_object("record", "$.k"))) == [(0, "1"), (0, "3"), (1, "2")]


def test_files_sort_folder_by_folder(spark):
    paths = ["/r/a-b/x", "/r/a/x", "/r/a/y", "/r/a.b/x"]
    df = spark.createDataFrame([(p,) for p in paths], "p string").orderBy(records.file_order(F.col("p")))
    assert [r[0] for r in df.collect()] == ["/r/a/x", "/r/a/y", "/r/a-b/x", "/r/a.b/x"]


def test_landing_is_incremental_and_once_per_name(spark, tmp_path):
    inbox, bronze, mark = (str(tmp_path / n) for n in ("inbox", "bronze", "mark"))
    write_zip(tmp_path / "inbox/2023q1/e1.zip", d__json={"results": [{"k": 1}]})
    land_archives(spark, inbox, bronze, mark)
    assert read_bronze(spark, bronze).count() == 1
    land_archives(spark, inbox, bronze, mark)
    assert read_bronze(spark, bronze).count() == 1
    write_zip(tmp_path / "inbox/2023q2/e1.zip", d__json={"results": [{"k": 2}, {"k": 3}]})
    # Same landing name under another path: landed before, so skipped.
    write_zip(tmp_path / "inbox/copy/2023q1/e1.zip", d__json={"results": [{"k": 4}]})
    land_archives(spark, inbox, bronze, mark)
    found = read_bronze(spark, bronze)
    assert sorted(json.loads(r["record"])["k"] for r in found.collect()) == [1, 2, 3]
    assert found.columns == RAW_RECORD.names


def test_landing_opens_each_archive_once(spark, tmp_path):
    """Bytes read from files, by Hadoop's own counter: one pass over new archives, and none over those landed before."""
    inbox, bronze, mark = (str(tmp_path / n) for n in ("inbox", "bronze", "mark"))
    filler = os.urandom(3_000_000).hex()
    for k in range(3):
        write_zip(tmp_path / f"inbox/202{k}q1/e{k}.zip", d__json={"meta": filler, "results": [{"k": k}]})
    size = sum(f.stat().st_size for f in (tmp_path / "inbox").rglob("*.zip"))
    statistics = spark._jvm.org.apache.hadoop.fs.FileSystem

    def bytes_read():
        return sum(s.getBytesRead() for s in statistics.getAllStatistics() if s.getScheme() == "file")

    before = bytes_read()
    land_archives(spark, inbox, bronze, mark, batch_files=2)
    first = bytes_read() - before
    assert size <= first < 1.5 * size
    land_archives(spark, inbox, bronze, mark, batch_files=2)
    assert bytes_read() - before - first < 0.1 * size
    assert sorted(json.loads(r["record"])["k"] for r in read_bronze(spark, bronze).collect()) == [0, 1, 2]


def test_bronze_is_empty_before_the_first_landing(spark, tmp_path):
    assert read_bronze(spark, str(tmp_path / "none")).count() == 0


def test_partition_index(spark, tmp_path, rows):
    parts = [
        {"file": "https://x/device/event/2019q1/device-event-0001.json.zip", "display_name": "2019 Q1 (part 1)", "size_mb": "80.5"},
        {"file": "https://x/event/2018/e.zip", "display_name": "old", "size_mb": "10"},
        {"file": "https://x/event/all/e-0001.json.zip", "display_name": "undated", "size_mb": None},
        {"file": "https://x/event/(2024)/e.zip", "display_name": "1999 and later", "size_mb": "bad"},
    ]
    path = tmp_path / "index.json"
    path.write_text(json.dumps({"results": {"device": {"event": {"partitions": parts}}}}))
    index = partition_index.read_partition_index(spark, str(path))
    kept = partition_index.prune_partitions(index, 2019, 2025)
    assert rows(kept, "display_name", "year") == sorted([("2019 Q1 (part 1)", 2019), ("undated", None), ("1999 and later", 2024)], key=repr)
    assert rows(partition_index.landed_volume(kept)) == [(3, 80.5)]
    assert rows(partition_index.landed_volume(kept.limit(0))) == [(0, 0.0)]
    assert "2019q1_device-event-0001.json.zip" in {r[0] for r in index.select(partition_index.landing_name(F.col("file"))).collect()}


def test_tables_and_views(spark, tmp_path, rows):
    df = spark.createDataFrame([("b", 2020), ("a", 2019), ("c", None)], "k string, year int")
    tables.write_table(df, str(tmp_path / "t"))
    assert tables.read_table(spark, str(tmp_path / "t"), ["k"]).columns == ["k"]
    tables.register_view(spark, "in_window", str(tmp_path / "t"), "year", 2019, 2019)
    assert rows(spark.sql("SELECT k FROM in_window")) == [("a",)]
    tables.register_view(spark, "all_rows", str(tmp_path / "t"), "year", None, None)
    assert spark.table("all_rows").count() == 3
    assert tables.read_if_present(spark, str(tmp_path / "none")) is None
    tables.write_csv(df, str(tmp_path / "c"), [F.col("k")], capped=True)
    assert [r["k"] for r in tables.read_csv(spark, str(tmp_path / "c")).collect()] == ["a", "b", "c"]
    assert tables.read_csv(spark, str(tmp_path / "c"), df.schema).schema == df.schema
    alias = spark.createDataFrame([("x", True), ("y", False)], "raw_name string, manual_review_flag boolean")
    tables.write_review(alias, str(tmp_path / "r"))
    assert [r["raw_name"] for r in tables.read_csv(spark, str(tmp_path / "r")).collect()] == ["x"]
