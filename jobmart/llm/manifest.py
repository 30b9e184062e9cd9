"""A Merkle manifest of a table: a digest for each row, a tree for each group, and a tree over the groups' roots.

A tree pairs consecutive nodes, level by level; the last one of an odd level is digested alone. Leaves ascend by id in
their group. Their places come from bitmaps: each task makes compressed bitmaps of its ids, which are merged by group
and range; counts of whole bitmaps, summed up in a directory of bounded fan-out, and the counts of bits inside one give
the rank of an id, so that no rows are sorted. Places key arrays of ``WIDTH`` slots, each of which one task reduces to
its top; the tops fill the arrays of the next round. A proof goes the other way: what lies beside a leaf in its array,
then beside the array in the next round, up to the root of all groups.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm.bitmaps import LOW_BITS, SIZE, Container
from jobmart.llm.common import stored

#: Levels that one array of slots reduces, and its slots.
LEVELS = 10
WIDTH = 1 << LEVELS
#: Children of a node of the directory of bitmaps: 2 to this power.
FAN_BITS = 12
#: Ids a task holds before it writes out their bitmaps.
HELD = 1 << 20
_DIGEST = 32


# -- digests ------------------------------------------------------------------


def encoded(value: Column) -> Column:
    """A value's UTF-8 length and text, or ``-`` for null; different values never have the same ends and beginnings."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(*values: Column) -> Column:
    """The digest of a row's values, 32 bytes."""
    return F.unhex(F.sha2(F.concat(*[encoded(v) for v in values]).cast("binary"), 256))


def _of(text: bytes) -> bytes:
    return hashlib.sha256(text).digest()


def above(level: bytes) -> bytes:
    """The next level of nodes; digests are joined as hexadecimal text."""
    text, pair = level.hex().encode(), 4 * _DIGEST
    return b"".join(_of(text[i : i + pair]) for i in range(0, len(text), pair))


def height(leaves: int) -> int:
    return (leaves - 1).bit_length()


def fold(leaf: bytes, places: list[tuple[int, int]], proof: list[bytes]) -> bytes:
    """The root that a leaf and a proof give: ``places`` has the place and the size of each tree, from below."""
    node, left = leaf, iter(proof)
    for place, size in places:
        while size > 1:
            if place ^ 1 >= size:
                pair = [node]
            elif place % 2:
                pair = [next(left), node]
            else:
                pair = [node, next(left)]
            node = _of(b"".join(pair).hex().encode())
            place, size = place // 2, (size + 1) // 2
    return node


# -- places -------------------------------------------------------------------


def _leaves(docs: DataFrame, doc_id: str, group: str, leaf: Column, claim: Column) -> DataFrame:
    """``key``, ``part``, ``number``, ``leaf``, ``claim`` and ``copies``: equal rows are one from here on.

    Null groups have the key that is first in order. Null ids are a part of their own, numbered by their digest.
    """
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group).cast("string")), F.lit("")).alias("key"),
        F.col(doc_id).cast("long").alias("number"), leaf.alias("leaf"), claim.alias("claim"),
    )
    prefix = F.conv(F.substring(F.hex("leaf"), 1, 15), 16, 10).cast("long")
    rows = rows.select("key", F.col("number").isNotNull().cast("int").alias("part"), F.coalesce("number", prefix).alias("number"), "leaf", "claim")
    return rows.groupBy("key", "part", "number", "leaf", "claim").agg(F.count("*").alias("copies"))


def _bitmaps(leaves: DataFrame) -> DataFrame:
    """``key``, ``part``, ``high``, ``n`` and ``bitmap`` of each range of numbers in which there are any."""
    schema = "key string, part int, high long, n long, bitmap binary"

    def written(held: dict) -> pd.DataFrame:
        rows = []
        for (key, part, high), found in held.items():
            both = pd.concat(found)
            made = Container.of((both["number"] % SIZE).to_numpy(), both["copies"].to_numpy())
            rows.append((key, part, high, len(made), made.pack()))
        return pd.DataFrame(rows, columns=["key", "part", "high", "n", "bitmap"])

    def partial(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, n = defaultdict(list), 0
        for batch in batches:
            for place, rows in batch.groupby(["key", "part", batch["number"] // SIZE], sort=False):
                held[place].append(rows[["number", "copies"]])
            n += len(batch)
            if n >= HELD:
                yield written(held)
                held, n = defaultdict(list), 0
        if held:
            yield written(held)

    def merged(place: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        made = Container.merged([Container.unpack(b) for b in rows["bitmap"]])
        return pd.DataFrame([(*place, len(made), made.pack())], columns=["key", "part", "high", "n", "bitmap"])

    parts = leaves.select("key", "part", "number", "copies").mapInPandas(partial, schema)
    return parts.groupBy("key", "part", "high").applyInPandas(merged, schema)


def _directory(bitmaps: DataFrame) -> DataFrame:
    """``bitmaps`` with ``base``, the leaves of the group before each, and ``total``, all leaves of the group.

    Counts are summed up in nodes of ``2 ** FAN_BITS`` ranges at a time, as many levels as the ranges span, so that no
    running sum goes over more rows than that.
    """
    span = bitmaps.agg(F.min("high").alias("low"), F.max("high").alias("high")).first()
    low, high, levels = span["low"] or 0, span["high"] or 0, 0
    while (low >> FAN_BITS * levels, high >> FAN_BITS * levels) != (-1, 0) and low >> FAN_BITS * levels != high >> FAN_BITS * levels:
        levels += 1
    nodes = [bitmaps.select("key", "part", F.col("high").alias("node"), "n")]
    for _ in range(levels):
        up = F.shiftright("node", FAN_BITS).alias("node")
        nodes.append(nodes[-1].groupBy("key", "part", up).agg(F.sum("n").alias("n")))
    parts = Window.partitionBy("key").orderBy("part", "node")  # one node a part, or two: below and above zero
    found = nodes[-1].select(
        "key", "part", "node", F.coalesce(F.sum("n").over(parts.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"),
        F.sum("n").over(Window.partitionBy("key")).alias("total"),
    )
    for level in reversed(nodes[:-1]):
        beside = Window.partitionBy("key", "part", "up").orderBy("node").rowsBetween(Window.unboundedPreceding, -1)
        below = level.withColumn("up", F.shiftright("node", FAN_BITS))
        below = below.withColumn("earlier", F.coalesce(F.sum("n").over(beside), F.lit(0)))
        found = below.join(found.withColumnRenamed("node", "up"), ["key", "part", "up"]).select(
            "key", "part", "node", (F.col("base") + F.col("earlier")).alias("base"), "total"
        )
    return bitmaps.join(found.withColumnRenamed("node", "high"), ["key", "part", "high"])


def _placed(leaves: DataFrame, directory: DataFrame) -> DataFrame:
    """``key``, ``total``, ``slot`` of the first copy, ``copies``, ``id``, ``leaf`` and ``claim`` of each leaf.

    Different rows of one id follow each other by their digests; they meet in one task.
    """
    columns = ["key", "total", "slot", "copies", "id", "leaf", "claim"]

    def ranked(rows: pd.DataFrame, bitmap: pd.DataFrame) -> pd.DataFrame:
        found = Container.unpack(bitmap["bitmap"].iloc[0])
        lows = (rows["number"] % SIZE).to_numpy()
        rows["slot"] = bitmap["base"].iloc[0] + found.rank(lows)
        rows["total"] = bitmap["total"].iloc[0]
        tied = rows["number"].duplicated(keep=False)
        if tied.any():
            ties = rows[tied].sort_values(["number", "leaf", "claim"])
            rows.loc[ties.index, "slot"] += ties.groupby("number")["copies"].cumsum() - ties["copies"]
        rows["id"] = rows["number"].astype(str).where(rows["part"] == 1, None)
        return rows[columns]

    at = ["key", "part", "high"]
    rows = leaves.withColumn("high", F.shiftright("number", LOW_BITS)).groupBy(*at)
    return rows.cogroup(directory.groupBy(*at)).applyInPandas(
        ranked, "key string, total long, slot long, copies long, id string, leaf binary, claim binary"
    )


def _numbered(keys: DataFrame) -> DataFrame:
    """``keys`` with ``slot``, their place in order, and ``total``; only counts of partitions come to the driver."""
    within = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    ordered = keys.repartitionByRange("key").sortWithinPartitions("key")
    ordered = stored(ordered.select("*", F.spark_partition_id().alias("_part"), within.alias("_at")), "keys")
    first, total = {}, 0
    for row in sorted(ordered.groupBy("_part").count().collect()):
        first[row["_part"]] = total
        total += row["count"]
    starts = F.create_map(*[F.lit(x) for pair in (first or {0: 0}).items() for x in pair])
    slot = (starts[F.col("_part")] + F.col("_at")).cast("long")
    return ordered.select(*keys.columns, slot.alias("slot"), F.lit(total).cast("long").alias("total"))


# -- trees --------------------------------------------------------------------


def _arrays(nodes: DataFrame, carried: dict[str, str]) -> DataFrame:
    """Nodes as arrays of slots: ``key``, ``block``, ``total`` and ``slots``, the digests one after the other.

    A node stands for ``copies`` equal ones from ``slot`` on. ``carried`` names further columns and their types; they
    become arrays in the order of the slots.
    """
    end = F.col("slot") + F.col("copies")
    nodes = nodes.withColumn("block", F.explode(F.sequence(F.shiftright("slot", LEVELS), F.shiftright(end - 1, LEVELS))))
    base = F.shiftleft("block", LEVELS)
    first = F.greatest("slot", base)
    nodes = nodes.withColumn("at", first - base).withColumn("times", F.least(end, base + WIDTH) - first)

    def filled(place: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        key, block = place
        total = int(rows["total"].iloc[0])
        size = min(WIDTH, total - block * WIDTH)
        slots, more = bytearray(_DIGEST * size), {c: [None] * size for c in carried}
        for row in rows.itertuples():
            slots[_DIGEST * row.at : _DIGEST * (row.at + row.times)] = row.leaf * row.times
            for c, values in more.items():
                value = getattr(row, c)
                values[row.at : row.at + row.times] = [value] * row.times
        return pd.DataFrame([(key, block, total, bytes(slots), *more.values())], columns=["key", "block", "total", "slots", *more])

    types = "".join(f", {c} array<{t}>" for c, t in carried.items())
    return nodes.groupBy("key", "block").applyInPandas(filled, f"key string, block long, total long, slots binary{types}")


@dataclass(frozen=True)
class Tree:
    """``rounds`` has the arrays of slots, leaves first; ``tops`` the ``key`` and ``digest`` of each tree."""

    rounds: list[DataFrame]
    tops: DataFrame


def _climb(nodes: DataFrame, carried: dict[str, str], name: str) -> Tree:
    """Reduce all trees, ``LEVELS`` levels at a time. ``nodes`` has key, total, slot, copies, leaf and what is carried."""

    @F.pandas_udf("binary")
    def top(slots: pd.Series, totals: pd.Series) -> pd.Series:
        found = []
        for level, total in zip(slots, totals, strict=True):
            for _ in range(min(LEVELS, height(total))):
                level = above(level)
            found.append(level)
        return pd.Series(found)

    rounds, most = [], 2
    while most > 1:
        arrays = stored(_arrays(nodes, carried), f"{name}-{len(rounds)}")
        rounds.append(arrays)
        blocks = F.shiftright(F.col("total") + (WIDTH - 1), LEVELS)
        nodes = arrays.select("key", blocks.alias("total"), F.col("block").alias("slot"), F.lit(1).cast("long").alias("copies"),
                              top("slots", "total").alias("leaf"))
        carried, most = {}, arrays.agg(F.max(blocks)).first()[0] or 0
    return Tree(rounds, nodes.select("key", F.col("leaf").alias("digest")))


def beside(slots: bytes, total: int) -> Iterator[list[bytes]]:
    """For each slot of an array, what lies beside it and its ancestors in that array."""
    levels = [slots]
    for _ in range(min(LEVELS, height(total))):
        levels.append(above(levels[-1]))
    for i in range(len(slots) // _DIGEST):
        found = []
        for up, level in enumerate(levels[:-1]):
            j = ((i >> up) ^ 1) * _DIGEST
            if j < len(level):
                found.append(level[j : j + _DIGEST])
        yield found


def _proofs(tree: Tree, name: str) -> DataFrame:
    """``key``, ``block`` and ``path`` of each array of leaves: what lies beside the array and its ancestors."""
    path = tree.tops.select("key", F.lit(0).cast("long").alias("block"), F.array().cast("array<binary>").alias("path"))
    for arrays in reversed(tree.rounds[1:]):

        def downwards(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for row in batch.itertuples():
                    first = row.block * WIDTH
                    found = [(row.key, first + i, [*own, *row.path]) for i, own in enumerate(beside(row.slots, row.total))]
                    yield pd.DataFrame(found, columns=["key", "block", "path"])

        path = stored(arrays.join(path, ["key", "block"]).mapInPandas(downwards, "key string, block long, path array<binary>"), name)
    return path


# -- the manifest -------------------------------------------------------------


def build(docs: DataFrame, leaf: Column, claim: Column | None = None, doc_id: str = "doc_id", group: str = "lang") -> DataFrame:
    """A row for each row of ``docs``: its place in the manifest, its proof, and whether a claim is proved by it.

    Columns: ``doc_id``, ``group`` (as text), ``slot`` and ``group_size``, ``leaf``, ``subroot`` of the group, ``root``
    of all, ``proof`` (what lies beside the leaf, level by level; digests as hexadecimal text), ``folded_root``, the
    root that ``claim`` gives with this proof, and ``verified``, whether that is the root. ``leaf`` and ``claim`` are
    digests of 32 bytes, see ``digest``; without a claim it is the leaf itself.

    Groups are in the order of their names, null first; a group's leaves ascend by id. Null ids come first, by digest;
    of rows with the same id those of lower digests do. Equal rows have a leaf each. Columns of ``docs`` by any name
    do no harm. An empty table gives no rows.
    """
    claim = leaf if claim is None else claim
    leaves = stored(_leaves(docs, doc_id, group, leaf, claim), "leaves")
    bitmaps = stored(_bitmaps(leaves), "bitmaps")
    placed = _placed(leaves, _directory(bitmaps))
    tree = _climb(placed, {"id": "string", "claim": "binary"}, "slots")
    keys = _numbered(tree.tops)
    above_keys = keys.select(F.lit("").alias("key"), "total", "slot", F.lit(1).cast("long").alias("copies"), F.col("digest").alias("leaf"), F.col("key").alias("name"))
    whole = _climb(above_keys, {"name": "string"}, "subroots")
    tops = whole.rounds[0].join(_proofs(whole, "root-paths"), ["key", "block"]).join(whole.tops, "key")
    paths = _proofs(tree, "paths")

    def groups(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                names, first = list(row.name), row.block * WIDTH
                yield pd.DataFrame(
                    [
                        (names[i], first + i, row.total, row.slots[i * _DIGEST : (i + 1) * _DIGEST], [*own, *row.path], row.digest)
                        for i, own in enumerate(beside(row.slots, row.total))
                    ],
                    columns=["key", "place", "groups", "subroot", "up", "root"],
                )

    roots = stored(tops.mapInPandas(groups, "key string, place long, groups long, subroot binary, up array<binary>, root binary"), "roots")
    columns = ["doc_id", "group", "slot", "group_size", "leaf", "subroot", "root", "proof", "folded_root", "verified"]

    def proved(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                out, first, more = [], row.block * WIDTH, [*row.path, *row.up]
                ids, claims = list(row.id), list(row.claim)
                for i, own in enumerate(beside(row.slots, row.total)):
                    proof = own + more
                    places = [(first + i, row.total), (row.place, row.groups)]
                    found = fold(claims[i], places, proof)
                    out.append((
                        None if ids[i] is None else int(ids[i]), row.key[1:] if row.key else None, first + i, row.total,
                        row.slots[i * _DIGEST : (i + 1) * _DIGEST].hex(), row.subroot.hex(), row.root.hex(),
                        b"".join(proof).hex(), found.hex(), found == row.root,
                    ))
                yield pd.DataFrame(out, columns=columns).astype({"doc_id": "Int64"})

    arrays = tree.rounds[0].join(paths, ["key", "block"]).join(roots, "key")
    return arrays.mapInPandas(
        proved, "doc_id long, group string, slot long, group_size long, leaf string, subroot string, root string, "
        "proof string, folded_root string, verified boolean",
    )
