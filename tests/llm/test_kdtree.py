import random
from collections import defaultdict

from pyspark.sql import functions as F

from basketry.llm.kdtree import kd_tree_shards


def shards(spark, rows, count, **more):
    docs = spark.createDataFrame(rows, "doc_id long, size long, host long, mark string").repartition(5)
    dims = [F.log2("size"), F.col("doc_id"), F.col("host")]
    return kd_tree_shards(docs, "size", dims, ["doc_id", "mark"], count, **more).collect()


def test_sizes_are_near_equal_and_slots_gapless(spark):
    pick = random.Random(1)
    # A third of all rows agree in every dimension but the id.
    rows = [(i, 16 + int(pick.lognormvariate(6, 1)) if i % 3 else 500, i % 3 and pick.randrange(9), "m")
            for i in range(3000)]
    found = shards(spark, rows, 40)
    bytes_of, slots = defaultdict(int), defaultdict(list)
    for r in found:
        bytes_of[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert sorted(r["doc_id"] for r in found) == list(range(3000)) and set(bytes_of) == set(range(40))
    mean = sum(bytes_of.values()) / 40
    assert max(abs(b - mean) for b in bytes_of.values()) < max(r[1] for r in rows)
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())


def test_equal_input_gives_equal_shards(spark):
    rows = [(i * 37 % 500, 16 + i % 91, i % 4, "m") for i in range(500)]
    place = lambda found: sorted((r["doc_id"], r["shard"], r["slot"]) for r in found)
    assert place(shards(spark, rows, 7)) == place(shards(spark, rows[::-1], 7))


def test_leaves_are_boxes_of_a_tree(spark):
    """With one dimension and exact cuts the shards are runs of the sorted rows."""
    rows = [(i, 10, 0, "m") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id long, size long, host long, mark string")
    found = kd_tree_shards(docs, "size", [F.col("doc_id")], ["doc_id"], 8, slack=0.0).collect()
    assert {r["doc_id"]: r["shard"] for r in found} == {i: i // 100 for i in range(800)}


def test_few_rows_and_null_metadata(spark):
    found = shards(spark, [(1, 16, None, "a"), (None, 20, 3, None), (2, 16, None, "a")], 40)
    assert len(found) == 3 and all(0 <= r["shard"] < 40 for r in found)


def test_thousands_of_shards(spark):
    """Leaves by the thousand, a third of all rows in one place: near-equal sizes, no gap in slots."""
    pick = random.Random(4)
    rows = [(i, 16 + pick.randrange(50) if i % 3 else 40, i % 3 and pick.randrange(999), "m") for i in range(12_288)]
    found = shards(spark, rows, 4096)
    bytes_of, slots = defaultdict(int), defaultdict(list)
    for r in found:
        bytes_of[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert len(found) == 12_288 and set(bytes_of) <= set(range(4096)) and len(bytes_of) > 4000
    assert max(bytes_of.values()) <= 3 * sum(bytes_of.values()) / 4096
    assert all(sorted(held) == list(range(len(held))) for held in slots.values())


def test_any_number_of_shards(spark):
    rows = [(i, 10, 0, "m") for i in range(660)]
    docs = spark.createDataFrame(rows, "doc_id long, size long, host long, mark string")
    for count in (1, 2, 11):
        found = kd_tree_shards(docs, "size", [F.col("doc_id")], ["doc_id"], count, slack=0.0).collect()
        assert {r["doc_id"]: r["shard"] for r in found} == {i: i // (660 // count) for i in range(660)}


def brute_tree(rows, shards):
    """Shards of (keys, size) rows: sorted by the widest key, cut where the left half's bytes lie."""
    places = [0] * len(rows)

    def split(ids, first, leaves):
        if leaves == 1 or not ids:
            for i in ids:
                places[i] = first
            return
        spread = [max(rows[i][0][d] for i in ids) - min(rows[i][0][d] for i in ids) for d in (0, 1)]
        dim, half = spread.index(max(spread)), leaves // 2
        ids = sorted(ids, key=lambda i: rows[i][0][dim])
        wanted, upto, cut = sum(rows[i][1] for i in ids) * half // leaves, 0, 0
        for cut, i in enumerate(ids):
            upto += rows[i][1]
            if upto >= wanted:
                break
        cut += upto - wanted < wanted - (upto - rows[ids[cut]][1])
        split(ids[:cut], first, half)
        split(ids[cut:], first + half, leaves - half)

    split(list(range(len(rows))), 0, shards)
    return places


def test_two_dimensions_equal_a_tree_in_plain_python(spark):
    pick = random.Random(8)
    # Distinct places in both dimensions, so hashes decide nothing.
    xs, ys = pick.sample(range(1001), 400), pick.sample(range(1001), 400)
    xs[:2] = ys[:2] = [-1, 1001]
    rows = [((x, y), pick.randrange(1, 90)) for x, y in zip(xs, ys)]
    docs = spark.createDataFrame(
        [(i, x, y, size) for i, ((x, y), size) in enumerate(rows)], "doc_id long, x long, y long, size long"
    )
    found = kd_tree_shards(docs, "size", [F.col("x"), F.col("y")], ["doc_id"], 13, slack=0.0).collect()
    places = brute_tree(rows, 13)
    assert {r["doc_id"]: r["shard"] for r in found} == dict(enumerate(places))
