import json
import random

import pytest
from pyspark.sql import functions as F

from basketry.sources import arrays, files
from basketry.sources.arrays import read_records

SPLIT = "spark.sql.files.maxPartitionBytes"
OPEN_COST = "spark.sql.files.openCostInBytes"
#: Braces, brackets, quotes and escapes where they mean nothing.
ODD = ['}', '{"a":1}', '"', '\\', '\\"', '[}{]', "é\U0001f600}", "a\\\\", "\n}", "],[", ""]


@pytest.fixture
def small_blocks(spark):
    before = {name: spark.conf.get(name) for name in (SPLIT, OPEN_COST)}
    spark.conf.set(SPLIT, "449")
    spark.conf.set(OPEN_COST, "449")
    yield
    for name, value in before.items():
        spark.conf.set(name, value)


def odd_records(n, seed=1):
    pick = random.Random(seed)

    def value(depth):
        if depth == 0 or pick.random() < 0.4:
            return pick.choice([*ODD, 1, -2.5, None, True, [], {}])
        if pick.random() < 0.5:
            return [value(depth - 1) for _ in range(pick.randrange(4))]
        return {pick.choice(ODD) + str(i): value(depth - 1) for i in range(pick.randrange(4))}

    return [{"id": i} | {f"k{j}": value(3) for j in range(pick.randrange(6))} for i in range(n)]


def read(spark, *paths):
    found = [json.loads(r["record"]) for r in read_records(spark, [str(p) for p in paths]).collect()]
    return sorted(found, key=lambda r: r["id"])


LAYOUTS = {
    "one line": lambda rows: json.dumps(rows, ensure_ascii=False),
    "escaped": lambda rows: json.dumps(rows),
    "indented": lambda rows: "\n " + json.dumps(rows, indent=2, ensure_ascii=False) + "\n\n",
    "lines": lambda rows: "\n".join(json.dumps(r, ensure_ascii=False) for r in rows),
    "lines with an end": lambda rows: "\r\n".join(json.dumps(r) for r in rows) + "\r\n",
    "byte order mark": lambda rows: "﻿" + json.dumps(rows),
}


@pytest.mark.parametrize("layout", LAYOUTS)
def test_a_file_of_many_blocks_equals_json_load(spark, tmp_path, small_blocks, layout):
    rows = odd_records(40)
    path = tmp_path / "rows.json"
    path.write_text(LAYOUTS[layout](rows), newline="")
    assert spark.read.text(str(path)).rdd.getNumPartitions() > 5
    assert read(spark, path) == rows


def test_large_records_cross_many_blocks(spark, tmp_path, small_blocks):
    rows = [{"id": i, "text": "x}" * n, "more": [{"y": "{" * (n // 2)}]} for i, n in enumerate([300, 0, 500, 1, 900])]
    path = tmp_path / "rows.json"
    path.write_text(json.dumps(rows))
    assert read(spark, path) == rows


def test_several_files_and_a_large_state_table(spark, tmp_path, small_blocks, monkeypatch):
    rows = odd_records(24, seed=2)
    (tmp_path / "a.json").write_text(json.dumps(rows[:9]))
    (tmp_path / "b c.json").write_text("\n".join(map(json.dumps, rows[9:17])))
    (tmp_path / "d.json").write_text(json.dumps(rows[17:], indent=1))
    (tmp_path / "empty.json").write_text("")
    (tmp_path / "none.json").write_text(" [ ]\n")
    assert read(spark, f"{tmp_path}/*.json") == rows
    monkeypatch.setattr(arrays, "BROADCAST_BLOCKS", 0)  # states are joined, not broadcast
    assert read(spark, f"{tmp_path}/*.json") == rows


def test_the_records_of_one_file_come_from_several_tasks(spark, tmp_path):
    rows = [{"id": i, "text": "word " * 40} for i in range(4000)]
    path = tmp_path / "rows.json"
    path.write_text(json.dumps(rows))
    before = spark.conf.get(SPLIT)
    spark.conf.set(SPLIT, "100k")
    try:
        found = read_records(spark, str(path)).groupBy(F.spark_partition_id()).count().collect()
        assert len(found) >= 8 and sum(r["count"] for r in found) == 4000
        assert max(r["count"] for r in found) < 1000
    finally:
        spark.conf.set(SPLIT, before)


@pytest.mark.parametrize(
    "text",
    ['[{"a": 1}', '[{"a": 1}, {"b', '{"a": 1', '[{"a": 1}]]', '[{"a": 1}, 2]', 'null', '[{"a": "}]', '{"a": 1}}'],
)
def test_what_is_no_run_of_objects_raises(spark, tmp_path, small_blocks, text):
    path = tmp_path / "rows.json"
    path.write_text(text)
    with pytest.raises(Exception, match="malformed"):
        read(spark, path)


def test_entities_from_an_array_of_many_blocks(spark, tmp_path, small_blocks):
    rows = [{"category_id": f"c{i}", "name": "One } [", "subcategories": [{"subcategory_id": "s", "profit_margin": 0.1}]} for i in range(50)]
    path = tmp_path / "categories.json"
    path.write_text(json.dumps(rows, indent=2))
    found = files.read_entity(spark, "categories", str(path)).collect()
    assert sorted(r["category_id"] for r in found) == sorted(r["category_id"] for r in rows)
    assert {r["name"] for r in found} == {"One } ["} and found[0]["subcategories"][0]["profit_margin"] == "0.1"
    lines = tmp_path / "lines.json"
    lines.write_text("\n".join(map(json.dumps, rows)))
    assert files.read_entity(spark, "categories", str(lines), "lines").count() == 50
    with pytest.raises(ValueError, match="layout"):
        files.read_entity(spark, "categories", str(lines), "rows")
