"""Hard-negative mining over shared candidate lists of anchor clusters.

Anchors are clustered by direction.  For a cluster, a candidate's inner product with any
member is at most the product of both lengths and the cosine of the angle between candidate
and centroid less the cluster's own radius.  That bound, apart from the member's length, is
the same for all members: the candidates are sorted by it once for the cluster, and every
member walks that list until the bound falls below what it still needs, which certifies
that nothing is left.

No task holds a whole list.  Anchors are dealt to panels of whole clusters, candidates to buckets
by a hash of the row, and a task has one bucket's part of the lists of one panel.  Buckets are
taken in rounds of growing size: what an anchor has found in one round is what it needs to
beat in the next, so later walks end early and give out little, and every candidate is in
one round.  The first rounds find the positives, which then set the windows that negatives
must lie in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import checkpointed

#: Anchors of a panel, candidates of a bucket, and buckets of the first round.
PANEL, BUCKET, FIRST_ROUND, GROWTH = 4096, 8192, 8, 8
#: Anchors that centroids are fitted on, members wanted in a cluster, and clusters at most.
SAMPLE, MEMBERS, MOST_CLUSTERS = 4096, 32, 256
_STEP = 512
#: Relative to both lengths; far above the error of angles in double precision.
_SLACK = 1e-6
_LAST = np.iinfo(np.int64).max


def _matrix(vectors, width: int) -> np.ndarray:
    """Vectors as rows, shorter ones filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for row, vector in zip(out, vectors, strict=True):
        row[: len(vector)] = vector
    return out


def _directions(matrix: np.ndarray) -> np.ndarray:
    lengths = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, lengths, out=np.zeros_like(matrix), where=lengths > 0)


def fit_centroids(vectors: np.ndarray, clusters: int, rounds: int = 10) -> np.ndarray:
    """Directions of ``clusters`` centroids at most, by spherical k-means from spread-out rows."""
    points = _directions(vectors)
    chosen = points[:1]
    nearest = points @ chosen[0]
    while len(chosen) < min(clusters, len(points)):
        chosen = np.vstack([chosen, points[np.argmin(nearest)]])
        nearest = np.maximum(nearest, points @ chosen[-1])
    for _ in range(rounds):
        of = np.argmax(points @ chosen.T, axis=1)
        sums = np.zeros_like(chosen)
        np.add.at(sums, of, points)
        moved = _directions(sums)
        chosen = np.where(np.abs(moved).sum(axis=1, keepdims=True) > 0, moved, chosen)
    return chosen


def cluster_bounds(members: np.ndarray, centroid: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """For each candidate at least its inner product with any member, divided by the member's length."""
    radius = np.arccos(np.clip(_directions(members) @ centroid, -1, 1))
    lengths = np.linalg.norm(candidates, axis=1)
    radius = radius[np.abs(members).sum(axis=1) > 0].max(initial=0.0)
    angles = np.arccos(np.clip(_directions(candidates) @ centroid, -1, 1))
    return lengths * (np.cos(np.maximum(angles - radius, 0)) + _SLACK)


@dataclass
class Wanted:
    """The best rows of an anchor within each of its windows ``lo`` to ``hi`` of scores."""

    lo: np.ndarray
    hi: np.ndarray
    count: int
    scores: np.ndarray
    idents: np.ndarray
    marks: np.ndarray
    fresh: np.ndarray
    least: float = 0.0
    most: float = 0.0

    def __post_init__(self):
        self.settle()

    def settle(self) -> None:
        """Keeps what is among the best of some window, and sets the scores that still matter."""
        self._pick(np.lexsort((self.marks, self.idents, -self.scores)))
        keep = np.zeros(len(self.scores), bool)
        need = []
        for lo, hi in zip(self.lo, self.hi, strict=True):
            inside = np.flatnonzero((self.scores >= lo) & (self.scores <= hi))[: self.count]
            keep[inside] = True
            if lo <= hi:
                need.append(self.scores[inside[-1]] if len(inside) == self.count else lo)
        self._pick(keep)
        self.least = min(need, default=np.inf)
        self.most = max(self.hi, default=-np.inf)

    def _pick(self, which: np.ndarray) -> None:
        self.scores, self.idents = self.scores[which], self.idents[which]
        self.marks, self.fresh = self.marks[which], self.fresh[which]

    def add(self, scores: np.ndarray, idents: np.ndarray, marks: np.ndarray) -> None:
        self.scores = np.concatenate((self.scores, scores))
        self.idents = np.concatenate((self.idents, idents))
        self.marks = np.concatenate((self.marks, marks))
        self.fresh = np.concatenate((self.fresh, np.ones(len(scores), bool)))
        self.settle()


def walk(
    wanted: list[Wanted],
    members: np.ndarray,
    bounds: np.ndarray,
    candidates: np.ndarray,
    idents: np.ndarray,
    marks: np.ndarray,
    allowed: np.ndarray,
) -> int:
    """Every member walks the candidates, sorted by ``bounds``, until it is certified to be done.

    ``allowed`` tells for each member and candidate whether they may meet.  Returns the number of
    inner products taken.
    """
    order = np.argsort(-bounds, kind="stable")
    lengths = np.linalg.norm(members, axis=1)
    going = np.arange(len(members))
    taken = 0
    for first in range(0, len(order), _STEP):
        bound = bounds[order[first]]
        least = np.array([wanted[i].least for i in going])
        going = going[lengths[going] * bound + _SLACK * lengths[going] >= least]
        if not len(going):
            break
        part = order[first : first + _STEP]
        scores = members[going] @ candidates[part].T
        taken += scores.size
        least = np.array([wanted[i].least for i in going])[:, None]
        most = np.array([wanted[i].most for i in going])[:, None]
        useful = allowed[np.ix_(going, part)] & (scores >= least) & (scores <= most)
        for at in np.flatnonzero(useful.any(axis=1)):
            hit = np.flatnonzero(useful[at])
            wanted[going[at]].add(scores[at, hit].astype(np.int64), idents[part[hit]], marks[part[hit]])
    return taken


def _checked(anchors: np.ndarray, candidates: np.ndarray) -> None:
    """Doubles are exact for these vectors, and scores times 100 fit a long."""
    most = np.abs(anchors).max(initial=0) * np.abs(candidates).max(initial=0) * anchors.shape[1]
    if most >= 2.0**53:
        raise ValueError("components are too large for exact scores")


def _unit(anchors: pa.Table, candidates: pa.Table, same_label: bool, count: int) -> Iterator[dict]:
    """What the anchors of a panel find in one bucket."""
    a, c = anchors.to_pandas(), candidates.to_pandas()
    if a.empty or c.empty:
        return
    centroids = [x for x in a["centroid"]]
    width = max(map(len, [*a["vec"], *c["vec"], *centroids]))
    vectors, others = _matrix(a["vec"], width), _matrix(c["vec"], width)
    _checked(vectors, others)
    idents = np.where(c["unnamed"], _LAST, c["ident"]).astype(np.int64)
    marks, labels = c["mark"].to_numpy(), c["label"].to_numpy()
    own = a["label"].to_numpy()
    allowed = (own[:, None] == labels[None, :]) == same_label
    for i, (ident, mark) in enumerate(zip(a["ident"], a["mark"], strict=True)):
        allowed[i, (idents == ident) & (marks == mark)] = False  # itself
    wanted = []
    for lo, hi, held in zip(a["lo"], a["hi"], a["held"], strict=True):
        held = [] if held is None else list(held)
        wanted.append(
            Wanted(
                np.array(lo, float), np.array(hi, float), count,
                np.array([h["score"] for h in held], np.int64),
                np.array([_LAST if h["unnamed"] else h["ident"] for h in held], np.int64),
                np.array([h["mark"] for h in held], np.int64),
                np.zeros(len(held), bool),
            )
        )
    for cluster in np.unique(a["cluster"]):
        of = np.flatnonzero(a["cluster"].to_numpy() == cluster)
        centroid = _matrix([centroids[of[0]]], width)[0]
        bounds = cluster_bounds(vectors[of], centroid, others)
        walk([wanted[i] for i in of], vectors[of], bounds, others, idents, marks, allowed[of])
    for row, w in zip(a["anchor"], wanted, strict=True):
        found = (x[w.fresh].tolist() for x in (w.scores, w.idents, w.marks))
        for score, ident, mark in zip(*found, strict=True):
            yield dict(anchor=row, score=score, ident=ident, unnamed=ident == _LAST, mark=mark)


_HITS = "anchor bigint, score bigint, ident bigint, unnamed boolean, mark bigint"
_HIT = pa.schema(
    [(name, pa.bool_() if kind == "boolean" else pa.int64())
     for name, kind in (column.split() for column in _HITS.split(", "))]
)


def _found(
    anchors: DataFrame, candidates: DataFrame, begin: int, end: int, panels: int,
    same_label: bool, count: int,
) -> DataFrame:
    """Hits of all anchors in the buckets from ``begin`` to ``end``, a task for each panel and bucket."""
    left = anchors.withColumn("bucket", F.explode(F.sequence(F.lit(begin), F.lit(end - 1))))
    right = candidates.withColumn("panel", F.explode(F.sequence(F.lit(0), F.lit(panels - 1))))

    def work(a: pa.Table, c: pa.Table) -> pa.Table:
        return pa.Table.from_pylist(list(_unit(a, c, same_label, count)), schema=_HIT)

    keys, other = ["panel", "bucket"], right.toDF(*right.columns)
    return left.groupBy(*keys).cogroup(other.groupBy(*keys)).applyInArrow(work, _HITS)


def _best(hits: DataFrame, windows: DataFrame, count: int) -> DataFrame:
    """The first ``count`` hits of each window (``anchor``, ``window``, ``lo``, ``hi``)."""
    inside = hits.join(windows, "anchor").filter("score >= lo and score <= hi")
    order = Window.partitionBy("anchor", "window").orderBy(
        F.desc("score"), "unnamed", "ident", "mark"
    )
    return (
        inside.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= count)
        .drop("lo", "hi")
    )


def _rounds(buckets: int, first: int, growth: int) -> Iterator[tuple[int, int]]:
    begin, end = 0, first
    while begin < buckets:
        yield begin, min(end, buckets)
        begin, end = end, end * growth


def _search(
    anchors: DataFrame, windows: DataFrame, rows: DataFrame, buckets: int, panels: int,
    same_label: bool, count: int, first: int, growth: int,
) -> DataFrame:
    """``anchor``, ``window``, ``rank`` and the hits that are best in it."""
    limits = windows.groupBy("anchor").agg(
        F.collect_list(F.struct("window", "lo", "hi")).alias("w")
    ).select("anchor", F.col("w.lo").alias("lo"), F.col("w.hi").alias("hi"))
    asked = anchors.join(limits, "anchor")
    best, hit = None, [column.split()[0] for column in _HITS.split(", ")]
    for begin, end in _rounds(buckets, first, growth):
        part = rows.filter((F.col("bucket") >= begin) & (F.col("bucket") < end))
        if best is None:
            now = asked.withColumn("held", F.array().cast(f"array<struct<{_HITS.replace(' ', ':').replace(',:', ',')}>>"))
        else:
            held = best.groupBy("anchor").agg(F.collect_set(F.struct(*hit)).alias("held"))
            now = asked.join(held, "anchor", "left")
        hits = _found(now, part, begin, end, panels, same_label, count)
        if best is not None:
            hits = hits.unionByName(best.select(hit).distinct())
        best = checkpointed(_best(hits, windows, count))
    return best


def _cleaned(
    rows: DataFrame, ident: str, vector: str, label: str
) -> DataFrame:
    """Rows that take part, equal ones once: ``ident``, ``unnamed``, ``label`` and whole-number ``vec``."""
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * 256).cast("double"))
    odd = F.exists(
        vector,
        lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")),
    )
    given = rows.filter(F.col(vector).isNotNull() & F.col(label).isNotNull() & ~odd)
    return given.select(
        F.col(ident).cast("long").alias("ident"),
        F.col(label).cast("long").alias("label"),
        whole.alias("vec"),
    ).distinct()


def _panels(counts: list[tuple[int, int]], panel: int) -> tuple[list[tuple[int, int, int]], int]:
    """For each cluster its first panel and number of panels, small clusters sharing one."""
    plan, now, held = [], 0, 0
    for cluster, n in counts:
        if n > panel:
            now += held > 0
            parts = -(-n // panel)
            plan.append((cluster, now, parts))
            now, held = now + parts, 0
            continue
        if held and held + n > panel:
            now, held = now + 1, 0
        plan.append((cluster, now, 1))
        held += n
    return plan, now + (held > 0)


def hard_negatives(
    rows: DataFrame,
    anchors: Column,
    ident: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    positives: int = 5,
    negatives: int = 5,
    ratio: tuple[int, int] = (80, 100),
    panel: int = PANEL,
    bucket: int = BUCKET,
    first_round: int = FIRST_ROUND,
    growth: int = GROWTH,
) -> DataFrame:
    """``anchor_id``, ``positive_id``, ``rank``, ``negative_id``, ``positive_score`` and
    ``negative_score`` of the rows that the condition ``anchors`` on ``ident`` and ``label`` picks.

    Components become floor(256 * x) and scores are their integer inner products; higher ones come
    first, ties by smaller ``ident`` (null last).  A row's positives are its first rows of the same label other
    than itself; the negatives of a positive are the first rows of other labels with a score from
    ``ratio[0]`` / ``ratio[1]`` of the positive's up to the positive's own, so a positive below
    zero has none.

    Rows with a null label, a null vector or a null or non-finite component take no part, nor does an
    anchor with a null ``ident``.  Rows equal in all three columns count once; rows that share an id but
    differ otherwise are different rows.  A shorter vector counts as filled up with zeros, an empty
    one scores zero.  Components so large that scores are not exact in doubles raise.  An empty
    table, or one without anchors, gives no rows.  Other columns are left out.

    Centroids are fitted on at most ``SAMPLE`` anchors; they steer the order of work only.
    """
    clean = _cleaned(rows, ident, vector, label)
    clean = checkpointed(
        clean.select(
            F.coalesce("ident", F.lit(0)).alias("ident"),
            F.col("ident").isNull().alias("unnamed"),
            "label",
            "vec",
            F.xxhash64("ident", "label", "vec").alias("mark"),
            F.coalesce(anchors & F.col("ident").isNotNull(), F.lit(False)).alias("asks"),
        )
    )
    total, asking = clean.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    buckets = max(1, -(-total // bucket))
    clean = clean.withColumn("bucket", F.pmod("mark", F.lit(buckets)).cast("int"))
    sample = clean.filter("asks").orderBy("mark", "ident").limit(SAMPLE).select("vec").collect()
    width = max((len(r["vec"]) for r in sample), default=0)
    clusters = min(MOST_CLUSTERS, max(1, asking // MEMBERS))
    if sample:
        centroids = fit_centroids(_matrix([r["vec"] for r in sample], width), clusters)
    else:
        centroids = np.zeros((1, 0))

    def nearest(vec: pd.Series) -> pd.Series:
        wide = max(width, max(map(len, vec), default=0))
        points = _matrix(list(vec), wide)
        return pd.Series(np.argmax(points @ _matrix(list(centroids), wide).T, axis=1))

    chosen = checkpointed(
        clean.filter("asks").select(
            F.monotonically_increasing_id().alias("anchor"),
            "ident",
            "label",
            "vec",
            "mark",
            F.pandas_udf(nearest, "int")("vec").alias("cluster"),
        )
    )
    counts = [tuple(r) for r in chosen.groupBy("cluster").count().orderBy("cluster").collect()]
    plan, panels = _panels(counts, panel)
    plan = rows.sparkSession.createDataFrame(
        [(c, f, n, centroids[c].tolist()) for c, f, n in plan],
        "cluster int, first int, parts int, centroid array<double>",
    )
    placed = chosen.join(F.broadcast(plan), "cluster").select(
        "anchor", "ident", "label", "vec", "mark", "cluster", "centroid",
        (F.col("first") + F.pmod(F.xxhash64("mark"), F.col("parts"))).cast("int").alias("panel"),
    )
    candidates = clean.select("ident", "unnamed", "label", "vec", "mark", "bucket")
    panels = max(1, panels)
    far = F.lit(float("inf"))
    anywhere = chosen.select(
        "anchor", F.lit(1).alias("window"), (-far).alias("lo"), far.alias("hi")
    )
    search = lambda windows, same, count: _search(
        placed, windows, candidates, buckets, panels, same, count, first_round, growth
    )
    pulled = search(anywhere, True, positives)
    low, high = ratio
    windows = pulled.select(
        "anchor",
        F.col("rank").alias("window"),
        # The least whole score that is not below the ratio; above the score if that is negative.
        F.expr(f"({low} * score + {high - 1}) div {high}").cast("double").alias("lo"),
        F.col("score").cast("double").alias("hi"),
    )
    pushed = search(windows, False, negatives)
    named = lambda c, o: F.when(~F.col(f"{c}.unnamed"), F.col(f"{c}.ident")).alias(o)
    p, n, a = pulled.alias("p"), pushed.alias("n"), chosen.alias("a")
    return (
        n.join(p, (F.col("n.anchor") == F.col("p.anchor")) & (F.col("n.window") == F.col("p.rank")))
        .join(a, F.col("n.anchor") == F.col("a.anchor"))
        .select(
            F.col("a.ident").alias("anchor_id"),
            named("p", "positive_id"),
            F.col("n.rank").cast("int").alias("rank"),
            named("n", "negative_id"),
            F.col("p.score").alias("positive_score"),
            F.col("n.score").alias("negative_score"),
        )
    )
