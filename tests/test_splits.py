"""Record arrays and JSON lines read in splits of every size, against the whole file."""

from __future__ import annotations

import json
import random

import pytest

from lakeflux.sources.files import explode_records, read_record_arrays, record_files, rejected_files
from lakeflux.sources.splits import line_heads, read_record_arrays_split, split_record_files
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

SCHEMA = StructType().add("id", LongType()).add("title", StringType()).add("tags", ArrayType(StringType())).add("sub", StructType().add("a", LongType()).add("b", StringType()))
TRICKY = ["", "}", "{", "}]", '"', '\\"', "\\\\", '\\', "a\nb", "[{}]", "é漢🙂", "\\u007d", "x" * 300, ',{"id":1}', '"}"', "\\}\\", "]"]


def record(r, i):
    out = {"id": i, "title": "".join(r.choice(TRICKY) for _ in range(r.randint(0, 4)))}
    if r.random() < 0.5:
        out["tags"] = [r.choice(TRICKY) for _ in range(r.randint(0, 3))]
    if r.random() < 0.5:
        out["sub"] = {"a": r.randint(0, 9), "b": r.choice(TRICKY)}
    if r.random() < 0.2:
        out["other"] = [[{"deep": {"er": [r.choice(TRICKY)]}}], {}]
    return out


def write_files(folder, seed=0, files=4):
    r = random.Random(seed)
    folder.mkdir(parents=True, exist_ok=True)
    for k in range(files):
        rows = [record(r, 100 * k + i) for i in range(r.randint(1, 12))]
        text = json.dumps(rows, ensure_ascii=r.random() < 0.5, indent=r.choice([None, None, 1, 4]))
        (folder / f"f{k}.json").write_text(r.choice(["", " ", "\n\t"]) + text + r.choice(["", "\n", " \r\n "]))
    (folder / "none.json").write_text(" [ ] ")


def plain(df):
    return sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda x: (x["file"], x["pos"]))


@pytest.mark.parametrize("split", [29, 1000, 1 << 20])
def test_records_are_those_of_the_whole_file(spark, tmp_path, split):
    write_files(tmp_path / "in", split)
    whole = read_record_arrays(spark, str(tmp_path / "in"), SCHEMA)
    got = read_record_arrays_split(spark, str(tmp_path / "in"), SCHEMA, split_bytes=split)
    assert got.schema.fieldNames() == whole.schema.fieldNames()
    assert plain(got) == plain(whole) and whole.count() > 8


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    from lakeflux.sources.splits import fixed_splits, split_lines

    write_files(tmp_path / "in", 3, 1)
    with fixed_splits(spark, 50):
        lines = split_lines(spark, str(tmp_path / "in"), "f0.json", True, "}")
        assert lines.select("start").distinct().count() > 5


BROKEN = {
    "cut.json": '[{"id": 1}, {"id": 2',
    "no_end.json": '[{"id": 1}',
    "no_start.json": '{"id": 1}]',
    "two_ends.json": '[{"id": 1}]]',
    "no_comma.json": '[{"id": 1} {"id": 2}]',
    "more.json": '[{"id": 1}] x',
    "empty.json": "",
    "blank.json": " \n",
    "text.json": "hello } world",
    "bad_record.json": '[{"id": 1}, {"id" 2}]',
    "bare.json": '[1, 2]',
    "quote.json": '[{"title": "never ends}]',
    "brackets.json": '[{"tags": ["a"}]',
}


@pytest.mark.parametrize("split", [150, 1 << 20])
def test_broken_files_are_rejected_whole(spark, tmp_path, split):
    write_files(tmp_path / "in", 9, 2)
    for name, text in BROKEN.items():
        (tmp_path / "in" / name).write_text(text)
    records, rejected = split_record_files(spark, str(tmp_path / "in"), SCHEMA, split_bytes=split)
    assert {r.file.rpartition("/")[2] for r in rejected.collect()} == set(BROKEN)
    kept = {r.file.rpartition("/")[2] for r in records.select("file").distinct().collect()}
    assert kept == {"f0.json", "f1.json"}
    with pytest.raises(ValueError, match="broken record file"):
        read_record_arrays_split(spark, str(tmp_path / "in"), SCHEMA, split_bytes=split)
    assert read_record_arrays_split(spark, str(tmp_path / "in"), SCHEMA, on_bad="reject", split_bytes=split).count() == records.count()


def test_whole_file_reader_reports_empty_and_large_files(spark, tmp_path):
    write_files(tmp_path / "in", 9, 2)
    (tmp_path / "in" / "empty.json").write_text("")
    parsed = record_files(spark, str(tmp_path / "in"), SCHEMA)
    assert {r.file.rpartition("/")[2] for r in rejected_files(parsed).collect()} == {"empty.json"}
    assert explode_records(parsed, "reject").count() > 0
    small = record_files(spark, str(tmp_path / "in"), SCHEMA, max_bytes=20)
    reasons = {r.file.rpartition("/")[2]: r.reason for r in rejected_files(small).collect()}
    assert set(reasons) == {"empty.json", "f0.json", "f1.json"} and reasons["f0.json"] == "larger than 20 bytes"
    assert {r.file.rpartition("/")[2] for r in small.where("reason is null").collect()} == {"none.json"}
    with pytest.raises(Exception, match="broken record file"):
        explode_records(parsed).collect()


@pytest.mark.parametrize("split", [40, 1 << 20])
def test_line_heads_for_one_and_many_splits(spark, tmp_path, split):
    r = random.Random(split)
    want = {}
    (tmp_path / "in").mkdir()
    for k in range(5):
        rows = [record(r, i) for i in range(r.randint(0, 12))]
        lines = [json.dumps(x) for x in rows]
        body = "".join(line + "\n" * r.randint(1, 2) for line in lines)
        (tmp_path / "in" / f"l{k}.json").write_text("\n" * r.randint(0, 2) + (body if k else body.rstrip("\n")))
        want[f"l{k}.json"] = [(i, x["id"], x["title"]) for i, x in enumerate(rows[:5])]
    got = line_heads(spark, str(tmp_path / "in"), SCHEMA, 5, split_bytes=split).collect()
    for name, rows in want.items():
        assert sorted((g.pos, g.id, g.title) for g in got if g.file.endswith(name)) == rows
    (tmp_path / "in" / "bad.json").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception):
        line_heads(spark, str(tmp_path / "in"), SCHEMA, 5, split_bytes=split).collect()


def tasks_of(spark, group, run):
    """What run returns, and the tasks of the largest stage of its jobs."""
    sc = spark.sparkContext
    sc.setJobGroup(group, group)
    try:
        out = run()
        tracker = sc.statusTracker()
        stages = {s for j in tracker.getJobIdsForGroup(group) if (job := tracker.getJobInfo(j)) for s in job.stageIds}
        return out, max(info.numTasks for s in stages if (info := tracker.getStageInfo(s)))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)


def test_small_splits_of_record_arrays_share_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.json").write_text(json.dumps([{"id": i, "title": TRICKY[i % len(TRICKY)]} for i in range(400)]))
    whole = read_record_arrays(spark, str(tmp_path / "in"), SCHEMA)
    got, most = tasks_of(spark, "record-arrays", lambda: plain(read_record_arrays_split(spark, str(tmp_path / "in"), SCHEMA, split_bytes=60)))
    assert got == plain(whole) and len(got) == 400
    assert most <= 32  # over 150 splits; 4 tasks a core, and one task may begin behind each of them


def test_small_splits_of_lines_share_tasks(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "f.json").write_text("".join(json.dumps({"id": i, "title": "x" * (i % 50)}) + "\n" for i in range(400)))
    got, most = tasks_of(spark, "line-heads", lambda: plain(line_heads(spark, str(tmp_path / "in"), SCHEMA, 50, split_bytes=60)))
    assert [(r["pos"], r["id"]) for r in got] == [(i, i) for i in range(50)]
    assert most <= 32
