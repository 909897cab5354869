"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources that claim
them).  A flow routes each pattern's words to its sources' quotas; the k-th
copy of a pattern's words costs more than the one before it (convex
repetition cost), so repeats are used only where a quota cannot be met
without them.  Documents are then laid on a line per pattern in seeded order
and the line is taken up to the flow.

Bounds: the driver holds one row per pattern and per source, never per
document; more than ``max_patterns`` patterns raise a ValueError.

Results: a null text has size 0 and is taken 0 times; a null source is the
source null (last in order); a document in no source is its own pattern and
takes part in none; rows equal in key and text are selected together;
documents with equal seeded hashes are ordered by key; an empty table gives
an empty table; columns named like a produced column are replaced.  Texts are
measured whole whatever their length.
"""

from __future__ import annotations

import heapq
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from harmoniq.llm.common import store, text_hash, without

# fixed value: a word is a run of characters other than space and \t..\r
WORD = r"[^\x20\x09-\x0D]+"
MAX_COPIES = 3
LINE_BUCKETS = 1024


def word_count(col: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(col), F.lit(WORD)), F.lit(0)).cast("bigint")


# ---- quotas and flow: small numbers on the driver -------------------------------------
def water_fill(sizes: Sequence[float], weights: Sequence[float], total: float, cap: float) -> list[float]:
    """Share ``total`` by weight; no share passes ``cap`` times its size, what
    is over goes to the others by weight until none is above."""
    share, open_, left = [0.0] * len(sizes), set(range(len(sizes))), float(total)
    while open_:
        w = sum(weights[i] for i in open_)
        if w <= 0:
            break
        over = [i for i in open_ if left * weights[i] / w > cap * sizes[i]]
        if not over:
            for i in open_:
                share[i] = left * weights[i] / w
            break
        for i in over:
            share[i] = cap * sizes[i]
            open_.discard(i)
        left -= sum(share[i] for i in over)
    return share


def min_cost_flow(capacity: Sequence[float], members: Sequence[Sequence[int]], quota: Sequence[float],
                  max_copies: int = MAX_COPIES) -> list[dict[int, float]]:
    """Words routed from pattern p to source s: {s: words} per pattern.

    Successive shortest paths with potentials.  A pattern offers its words
    ``max_copies`` times, the k-th copy at cost 2k - 1; a source takes its
    quota.  Every augmentation closes a copy or a quota or reroutes an
    earlier flow, so their number is bounded by the graph."""
    n_p, n_s = len(capacity), len(quota)
    src, sink = n_p + n_s, n_p + n_s + 1
    head: list[list[int]] = [[] for _ in range(n_p + n_s + 2)]
    to, cap, cost = [], [], []

    def arc(a, b, c, w):
        head[a].append(len(to)); to.append(b); cap.append(float(c)); cost.append(w)          # noqa: E702
        head[b].append(len(to)); to.append(a); cap.append(0.0); cost.append(-w)              # noqa: E702
    for p in range(n_p):
        for k in range(max_copies):
            arc(src, p, capacity[p], 2 * k + 1)
        for s in members[p]:
            arc(p, n_p + s, float("inf"), 0)
    for s in range(n_s):
        arc(n_p + s, sink, quota[s], 0)
    eps = 1e-9 * max(1.0, sum(quota))
    height = [0] * len(head)
    while True:
        dist, via = [None] * len(head), [-1] * len(head)
        dist[src], heap = 0, [(0, src)]
        while heap:
            d, a = heapq.heappop(heap)
            if d > dist[a]:
                continue
            for e in head[a]:
                if cap[e] > eps and (dist[to[e]] is None or d + cost[e] + height[a] - height[to[e]] < dist[to[e]]):
                    dist[to[e]] = d + cost[e] + height[a] - height[to[e]]
                    via[to[e]] = e
                    heapq.heappush(heap, (dist[to[e]], to[e]))
        if dist[sink] is None:
            break
        far = max(d for d in dist if d is not None)
        height = [h + (far if d is None else d) for h, d in zip(height, dist)]
        push, b = float("inf"), sink
        while b != src:
            push, b = min(push, cap[via[b]]), to[via[b] ^ 1]
        b = sink
        while b != src:
            cap[via[b]] -= push
            cap[via[b] ^ 1] += push
            b = to[via[b] ^ 1]
    flow: list[dict[int, float]] = [{} for _ in range(n_p)]
    for p in range(n_p):
        for e in head[p]:
            if not e & 1 and n_p <= to[e] < src and cap[e ^ 1] > eps:
                flow[p][to[e] - n_p] = cap[e ^ 1]
    return flow


# ---- the operator ---------------------------------------------------------------------
def mix(docs: DataFrame, memberships: Column, weights: Sequence[float] = (1, 2, 3), share: float = 1.0,
        max_copies: int = MAX_COPIES, id_col: str = "doc_id", text_col: str = "text", seed: int = 7,
        max_patterns: int = 20_000, buckets: int = LINE_BUCKETS) -> DataFrame:
    """One row per distinct (id, text): ``id``, ``text_hash``, ``rows`` (equal rows),
    ``size``, ``pattern`` (array of sources), ``copies``, ``taken``,
    ``copy_sources`` (the source each copy counts for) and ``quotas`` (map
    source -> (size, target)).

    ``memberships`` is an array<string> expression; source weights repeat
    ``weights`` over the sources in code-point order, null last."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), text_hash(text_col).alias("text_hash"),
                       word_count(text_col).alias("size"), F.array_distinct(memberships).alias("pattern"))
    # null sorts first in an array; sources order by code point with null last
    ordered = F.concat(F.array_sort(F.array_compact("pattern")),
                       F.filter("pattern", lambda x: x.isNull()))
    units = store(rows.withColumn("pattern", F.coalesce(ordered, F.array().cast("array<string>")))
                  .groupBy("id", "text_hash", "size", "pattern").agg(F.count(F.lit(1)).alias("rows")), "mix-units")
    totals = (units.groupBy("pattern").agg(F.sum(F.col("size") * F.col("rows")).alias("words"))
              .limit(max_patterns + 1).collect())
    if len(totals) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    plan = plan_flow([(tuple(r["pattern"]), int(r["words"])) for r in totals], weights, share, max_copies)
    return select_units(spark, units, plan, max_copies, seed, buckets)


def plan_flow(totals: list[tuple[tuple, int]], weights: Sequence[float], share: float, max_copies: int) -> dict:
    """Quotas by source and flow by pattern, from the words of each pattern."""
    totals = sorted(totals, key=lambda t: [(x is None, (x or "").encode("utf-8")) for x in t[0]])
    sources = sorted({s for p, _ in totals for s in p}, key=lambda x: (x is None, (x or "").encode("utf-8")))
    at = {s: i for i, s in enumerate(sources)}
    size = [0] * len(sources)
    for p, words in totals:
        for s in p:
            size[at[s]] += words
    total = sum(words for p, words in totals if p)
    target = water_fill(size, [weights[i % len(weights)] for i in range(len(sources))], share * total, max_copies)
    flow = min_cost_flow([w for _, w in totals], [[at[s] for s in p] for p, _ in totals], target, max_copies)
    return {"patterns": [p for p, _ in totals], "words": [w for _, w in totals], "sources": sources, "size": size,
            "target": target, "flow": flow}


def select_units(spark: SparkSession, units: DataFrame, plan: dict, max_copies: int, seed: int,
                 buckets: int) -> DataFrame:
    """Seeded selection.  Copy k of a pattern's documents fills the line from
    k * words to (k + 1) * words; a copy is taken where its middle lies below the
    pattern's flow and counts for the source whose segment holds the middle.
    Positions come from a cumulative sum in two levels (hash bucket, then rows of the
    bucket), so one hot pattern is spread over ``buckets`` groups."""
    segments = []
    for i, p in enumerate(plan["patterns"]):
        upto, cuts = 0.0, []
        for s, w in sorted(plan["flow"][i].items()):
            upto += w
            cuts.append((upto, plan["sources"][s]))
        segments.append((i, list(p), float(plan["words"][i]), upto, cuts,
                         [(plan["sources"].index(s), float(plan["size"][plan["sources"].index(s)]),
                           float(plan["target"][plan["sources"].index(s)]), s) for s in p]))
    plan_df = spark.createDataFrame(
        segments or [(-1, [], 0.0, 0.0, [], [])],
        "pattern_id int, pattern array<string>, words double, flow double, "
        "cuts array<struct<upto: double, source: string>>, "
        "quotas array<struct<at: int, size: double, target: double, source: string>>")
    u = units.join(plan_df, "pattern")           # one small row per pattern; Spark sees its size
    h = F.xxhash64("id", "text_hash", F.lit(seed))
    u = u.withColumn("__h", h).withColumn("__b", F.pmod("__h", F.lit(buckets)).cast("int")) \
         .withColumn("__w", F.col("size") * F.col("rows"))
    sums = u.groupBy("pattern_id", "__b").agg(F.sum("__w").alias("__n"))
    starts = sums.select("pattern_id", "__b", (F.sum("__n").over(
        Window.partitionBy("pattern_id").orderBy("__b")) - F.col("__n")).alias("__start"))
    within = Window.partitionBy("pattern_id", "__b").orderBy("__h", "id", "text_hash", "size")
    u = u.withColumn("__at", F.sum("__w").over(within) - F.col("__w")).join(starts, ["pattern_id", "__b"])
    middle = lambda k: F.col("__start") + F.col("__at") + F.col("__w") / 2 + k * F.col("words")
    taken = F.filter(F.transform(F.sequence(F.lit(0), F.lit(max_copies - 1)), lambda k: middle(k)),
                     lambda m: (m < F.col("flow")) & (F.col("__w") > 0))
    of = F.transform(F.col("__taken"), lambda m: F.element_at(
        F.filter("cuts", lambda c: m < c["upto"]), 1)["source"])
    return (u.withColumn("__taken", taken).withColumn("copy_sources", of)
            .select("id", "text_hash", "rows", "size", "pattern", F.size("__taken").alias("copies"),
                    (F.size("__taken") * F.col("size")).cast("bigint").alias("taken"), "copy_sources", "quotas"))


def apply_mix(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mixed corpus: every row of ``docs`` as many times as it was taken
    (rows equal in id and text but not in sources: the larger number)."""
    keep = (mixed.filter("copies > 0").groupBy(F.col("id").alias("__id"), F.col("text_hash").alias("__hash"))
            .agg(F.max("copies").alias("__copies")))
    base = without(docs, "__id", "__hash", "__copies")
    out = base.withColumn("__h", text_hash(text_col)).join(
        keep, F.col(id_col).eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__hash")))
    return (out.withColumn("__k", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select([F.col(f"`{c}`") for c in base.columns]))
