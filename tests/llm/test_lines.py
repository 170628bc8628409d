from collections import defaultdict

from basketry.llm.lines import line_dedup

SCHEMA = "doc_id long, source string, text string"


def brute(rows, ratio, times):
    texts, on = defaultdict(set), defaultdict(set)
    for _, host, text in rows:
        if host is not None and text is not None:
            texts[host].add(text)
            for line in text.split("\n"):
                on[host, line].add(text)
    found = {}
    for ident, host, text in rows:
        if text is None:
            found[ident] = None
            continue
        judged = host is not None
        found[ident] = "\n".join(
            x for x in text.split("\n")
            if not (judged and x.strip() and len(on[host, x]) > max(ratio * len(texts[host]), times - 1))
        )
    return found


def test_equals_brute_force(spark, monkeypatch):
    rows = [(i, "abc"[i % 3], f"top\nline {i}\n\nline {i % 7}\n \ntop\nfoot {i % 3 == i % 2}") for i in range(90)]
    rows += [(100 + i, "a", "a copy\nof one page") for i in range(200)]  # one page, not boilerplate
    rows += [(400, None, "top\nx"), (401, "a", None), (402, "a", ""), (403, "rare", "top\ntop"), (404, "a", "top")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    wanted = brute(rows, 0.2, 4)
    for most in (1000, 0):  # with and without a broadcast
        monkeypatch.setattr("basketry.llm.lines.BROADCAST_LINES", most)
        found = {r["doc_id"]: r for r in line_dedup(docs, max_ratio=0.2, min_times=4).collect()}
        assert {i: r["text"] for i, r in found.items()} == wanted
    assert found[100]["n_removed"] == 0 and found[0]["n_removed"] >= 2
    assert (found[401]["n_lines"], found[402]["n_lines"], found[404]["text"]) == (0, 1, "")


def test_hosts_of_any_size_lose_their_common_line(spark):
    sizes = (1, 2, 3, 9, 19, 20, 60)
    rows = [(100 * n + i, f"host {n}", f"common\nown {n} {i}\npair {i // 2}") for n in sizes for i in range(n)]
    found = line_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    lost = {n: {r["n_removed"] for r in found if r["source"] == f"host {n}"} for n in sizes}
    assert lost == {1: {0}, 2: {0}, 3: {1}, 9: {1}, 19: {1}, 20: {1}, 60: {1}}
