import json

import pytest
from pyspark.sql import functions as F

from basketry.plans import reports
from basketry.sources import files

ORDERS = [
    {"transaction_id": "a", "total": "12.5", "status": "completed", "campaign": {"code": "S", "steps": [1, 2.5]}},
    {"transaction_id": "b", "total": 3, "status": "shipped", "gift": True, "note": "} {"},
    {"transaction_id": "c", "total": None, "campaign": "none"},
]


@pytest.mark.parametrize("layout", ["objects", "lines"])
def test_fields_outside_the_schema_read_back_from_the_stored_table(spark, tmp_path, layout):
    text = json.dumps(ORDERS) if layout == "objects" else "\n".join(map(json.dumps, ORDERS)) + "\n\n"
    for name in ("users", "categories", "products"):
        (tmp_path / f"{name}.json").write_text("")
    (tmp_path / "transactions.json").write_text(text)
    (tmp_path / "sessions_0.json").write_text(json.dumps({"session_id": "s", "theme": "dark"}))
    raw = reports.read_inputs(spark, str(tmp_path), layout, documents=True)
    reports.write_cleaned(spark, raw, str(tmp_path / "out"), F.current_date())
    stored = spark.read.parquet(str(tmp_path / "out" / "tables" / "transactions"))
    code, step = files.field("$.campaign.code", "string"), files.field("$.campaign.steps[1]", "double")
    gift = files.field("$.gift", "boolean")
    rows = stored.select("transaction_id", "total", code, step, gift, F.to_json("document")).collect()
    found = {r[0]: tuple(r) for r in rows}
    assert found["a"][1:5] == (12.5, "S", 2.5, None)
    assert found["b"][1:5] == (3.0, None, None, True)
    assert found["c"][1:5] == (None, None, None, None)
    assert {i: json.loads(row[5]) for i, row in found.items()} == {o["transaction_id"]: o for o in ORDERS}
    sessions = spark.read.parquet(str(tmp_path / "out" / "tables" / "sessions"))
    assert [r[0] for r in sessions.select(files.field("$.theme", "string")).collect()] == ["dark"]


def test_documents_are_left_out_unless_asked_for(spark, tmp_path):
    path = tmp_path / "transactions.json"
    path.write_text(json.dumps(ORDERS))
    assert "document" not in files.read_entity(spark, "transactions", str(path)).columns
