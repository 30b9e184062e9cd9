"""Mixing sources to target weights by minimum-cost flow.

Documents may belong to several sources.  They are aggregated by membership pattern, the words of each pattern are
routed to the quotas of its sources, where every further repetition costs more, and documents are then selected in a
seeded order until a pattern's share is reached.

Only one row per pattern and per source reaches the driver; the documents are met by narrow aggregations in which a
source of any size is spread over ``BINS`` bins of the seeded order.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmart.llm.common import WORD, stored

MAX_REPEATS = 3
BINS = 4_096
#: More membership patterns than this do not fit the driver's flow problem; the operator then refuses.
MAX_PATTERNS = 20_000


def words(text: Column) -> Column:
    """The size of a text: its number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def cyclic_weights(sources: Sequence[str | None], weights: Sequence[int] = (1, 2, 3)) -> dict[str | None, int]:
    """Weights dealt in code point order of the sources, null last."""
    ordered = sorted(sources, key=lambda s: (s is None, s or ""))
    return {s: weights[i % len(weights)] for i, s in enumerate(ordered)}


def targets(sizes: Mapping[str | None, int], weights: Mapping[str | None, int]) -> dict[str | None, float]:
    """Words wanted of each source: shares of the total by weight, at most ``MAX_REPEATS`` times a source's size.

    What is above that limit goes to the other sources by weight, until none is above. Exact fractions are used, so
    the result does not depend on the order of the sources.
    """
    limit = {s: Fraction(MAX_REPEATS * n) for s, n in sizes.items()}
    rest, free, found = Fraction(sum(sizes.values())), set(sizes), {}
    while free:
        total = sum(weights[s] for s in free)
        full = {s for s in free if rest * weights[s] / total > limit[s]}
        if not full:
            found |= {s: rest * weights[s] / total for s in free}
            break
        found |= {s: limit[s] for s in full}
        rest -= sum(limit[s] for s in full)
        free -= full
    return {s: float(x) for s, x in found.items()}


def route(capacity: Sequence[tuple[tuple, int]], quota: Mapping[str | None, int]) -> list[tuple[int, dict]]:
    """How many words each pattern gives to each of its sources, at least total cost for the most words routed.

    ``capacity`` holds (pattern, words). A pattern's words are offered ``MAX_REPEATS`` times, the r-th time at cost
    r * r, so repetition is spread evenly. Successive cheapest paths; the result is integral.
    """
    names = list(quota)
    first, last, sources = 0, 1, {s: 2 + i for i, s in enumerate(names)}
    head, room, cost, out = [], [], [], [[] for _ in range(2 + len(names) + len(capacity))]

    def arc(a: int, b: int, cap: int, price: int) -> int:
        for x, y, c, p in ((a, b, cap, price), (b, a, 0, -price)):
            out[x].append(len(head))
            head.append(y)
            room.append(c)
            cost.append(p)
        return len(head) - 2

    given = []
    for i, (pattern, size) in enumerate(capacity):
        node = 2 + len(names) + i
        for r in range(1, MAX_REPEATS + 1):
            arc(first, node, size, r * r)
        given.append({s: arc(node, sources[s], MAX_REPEATS * size, 0) for s in pattern if s in sources})
    for s in names:
        arc(sources[s], last, quota[s], 0)
    while True:
        far: list[int | None] = [None] * len(out)
        far[first], by, queue, waiting = 0, [-1] * len(out), deque([first]), {first}
        while queue:
            x = queue.popleft()
            waiting.discard(x)
            for e in out[x]:
                y = head[e]
                if room[e] > 0 and (far[y] is None or far[x] + cost[e] < far[y]):
                    far[y], by[y] = far[x] + cost[e], e
                    if y not in waiting:
                        waiting.add(y)
                        queue.append(y)
        if far[last] is None:
            break
        path, x = [], last
        while x != first:
            path.append(by[x])
            x = head[by[x] ^ 1]
        amount = min(room[e] for e in path)
        for e in path:
            room[e] -= amount
            room[e ^ 1] += amount
    return [(sum(room[e ^ 1] for e in to.values()), {s: room[e ^ 1] for s, e in to.items()}) for to in given]


def _plan(spark: SparkSession, rows: list[tuple], fields: str) -> DataFrame:
    """A table of the driver's plan: a row per pattern or source, of which there are at most ``MAX_PATTERNS``."""
    return F.broadcast(spark.createDataFrame(rows, fields))


def mix(docs: DataFrame, sources: Column, size: Column, seed: int = 0, key: Sequence[str] = ("doc_id",)) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``taken``: words the mix takes of a document.

    ``sources`` is the array of the sources a document belongs to, null among them; of several, ``source_size`` and
    ``target`` are those of the first in the sorted array. A document belongs to no source if it is null or empty:
    it then is the sole source null's. Weights are dealt by ``cyclic_weights``, targets by ``targets``.

    Every document is taken whole, 0 to ``MAX_REPEATS`` times. Within a pattern all documents are taken as often as
    the flow allows, and those first in the order of a hash of ``seed`` and ``key`` once more, up to the share; one
    last document, whose size comes nearest to what is missing, closes the gap. Equal keys share their place, so rows
    that repeat are ordered by all other means equal and are taken alike. Documents of size 0 are never taken. An
    empty table gives an empty result. Columns of these four names are replaced.
    """
    spark = docs.sparkSession
    given = F.array_sort(F.array_distinct(sources), lambda a, b: F.when(a.isNull() & b.isNull(), 0)
                         .when(a.isNull(), 1).when(b.isNull(), -1).when(a < b, -1).when(a > b, 1).otherwise(0))
    members = F.when(F.size(F.coalesce(given, F.array())) == 0, F.array(F.lit(None).cast("string"))).otherwise(given)
    old = docs.drop("size", "source_size", "target", "taken")
    draw = F.xxhash64(F.lit(seed), *key)
    rows = docs.select(*old.columns, members.alias("_members"), size.alias("size"), draw.alias("_draw"))
    rows = rows.withColumn("_pattern", F.to_json("_members")).withColumn("_bin", F.pmod("_draw", F.lit(BINS)))
    # Sizes are worked out once for the plan, from which only these narrow rows are read again.
    narrow = stored(rows.select("_pattern", "_members", "_bin", "_draw", "size"), "mix-sizes")
    patterns = narrow.groupBy("_pattern").agg(F.first("_members").alias("members"), F.sum("size").alias("words"))
    narrow = narrow.where("size > 0")
    bins = narrow.groupBy("_pattern", "_bin").agg(F.sum("size").alias("words"))
    found = sorted(patterns.limit(MAX_PATTERNS + 1).collect())
    if len(found) > MAX_PATTERNS:
        raise ValueError(f"documents have more than {MAX_PATTERNS} patterns of membership")
    sizes: dict[str | None, int] = {}
    for _, of, n in found:
        for s in of:
            sizes[s] = sizes.get(s, 0) + n
    total, wanted = sum(n for _, _, n in found), {}
    if sizes:
        # Sources may overlap; the mix as a whole is as large as the documents are.
        share = Fraction(total, max(1, sum(sizes.values())))
        wanted = {s: x * float(share) for s, x in targets(sizes, cyclic_weights(list(sizes))).items()}
    flows = route([(tuple(of), n) for _, of, n in found], {s: round(x) for s, x in wanted.items()})
    plan = []
    for (name, of, n), (flow, _) in zip(found, flows, strict=True):
        passes = min(flow // n, MAX_REPEATS) if n else 0
        plan.append((name, int(passes), int(flow - passes * n), sizes[of[0]], wanted[of[0]]))
    shares = _plan(spark, plan, "_pattern string, passes int, missing long, source_size long, target double")

    # The bin in which a pattern's share ends, from sums per bin; only that bin's documents are then put in order.
    earlier = Window.partitionBy("_pattern").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    running = bins.join(shares, "_pattern").withColumn("before", F.coalesce(F.sum("words").over(earlier), F.lit(0)))
    ends = running.where("before <= missing and missing < before + words").select(
        "_pattern", F.col("_bin").alias("end_bin"), (F.col("missing") - F.col("before")).alias("left")
    )
    ends = spark.createDataFrame(ends.collect(), "_pattern string, end_bin long, left long")
    last = narrow.join(F.broadcast(ends), "_pattern").where("_bin = end_bin")
    places = last.groupBy("_pattern", "_draw", "left").agg(F.sum("size").alias("words"))
    in_turn = Window.partitionBy("_pattern").orderBy("_draw")
    upto = places.withColumn("upto", F.sum("words").over(in_turn)).where("upto <= left")
    cut = upto.groupBy("_pattern").agg(F.max("_draw").alias("end_draw"), F.max("upto").alias("got"))
    cut = ends.join(F.broadcast(cut), "_pattern", "left").select(
        "_pattern", "end_bin", "end_draw", (F.col("left") - F.coalesce("got", F.lit(0))).alias("gap")
    )
    cut = spark.createDataFrame(cut.collect(), "_pattern string, end_bin long, end_draw long, gap long")
    in_order = (F.col("_bin") < F.col("end_bin")) | (
        (F.col("_bin") == F.col("end_bin")) & F.coalesce(F.col("_draw") <= F.col("end_draw"), F.lit(False))
    )
    # Every place after the cut is a candidate for the gap; the aggregation keeps one per pattern.
    after = narrow.join(F.broadcast(cut), "_pattern").where(~in_order)
    after = after.groupBy("_pattern", "_draw", "gap").agg(F.sum("size").alias("words"))
    near = after.withColumn("off", F.abs(F.col("words") - F.col("gap"))).where("off < gap")
    closing = near.groupBy("_pattern").agg(F.min(F.struct("off", "_draw")).alias("best"))
    closing = spark.createDataFrame(
        [(p, b["_draw"]) for p, b in closing.collect()], "_pattern string, closing_draw long"
    )
    joined = rows.join(shares, "_pattern", "left").join(F.broadcast(cut), "_pattern", "left")
    joined = joined.join(F.broadcast(closing), "_pattern", "left")
    once_more = F.coalesce(in_order, F.lit(False)) | F.coalesce(F.col("_draw") == F.col("closing_draw"), F.lit(False))
    repeats = F.col("passes") + F.when(once_more & (F.col("passes") < MAX_REPEATS), 1).otherwise(0)
    return joined.select(
        *old.columns, "size", "source_size", "target", (F.col("size") * repeats).alias("taken")
    )
