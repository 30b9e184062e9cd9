"""Classes of near copies: DartMinHash signatures in bands, exact similarity of the candidates, connected components.

Texts are compared as weighted sets of their runs of five words, lower-cased, each weighing as often as it occurs; a
text of fewer words is one run. Two texts are linked if the weighted Jaccard similarity of these sets is at least 0.8,
and a class holds all texts that links connect.

Equal texts are one node from the start. Nodes that share a band are candidates, unless two bits of each coordinate of
their signatures already tell them apart. As only classes are wanted, most candidates need no comparison: first each
node is compared with the best connected node of its bands. Nodes of bands in which several classes are left then meet
by their rarest shingles alone: two sets of similarity s share an element among the first ``n - s n + 1`` of each in any
common order, and where they first meet tells how much they can share at most. Texts that stray from one original in
ways of their own meet nowhere, however many they are; no pair that is similar enough is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmart.llm import darts, words
from jobmart.llm.common import stored
from jobmart.llm.graph import components

SHINGLE = 5
SIMILARITY = 0.8
#: 30 bands of 6: a pair of similarity 0.8 shares one at 99.99 %, one of similarity 0.5 at 38 %.
ROWS, BANDS = 6, 30
#: Standard deviations by which a sketch may miss the threshold: a pair at the threshold is lost at 1 in a million.
DEVIATIONS = 4.75
_PER_LONG = 32


def shingles(data: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words' hashes, the distinct shingles, and how often each occurs; empty without words."""
    hashed = words.hashes(data, *words.bounds(data))
    runs = words.windows(hashed, min(size, len(hashed))) if len(hashed) else hashed
    distinct, counts = np.unique(runs, return_counts=True)
    return hashed, distinct, counts


def _prepared(text: Column) -> Column:
    return F.lower(text).cast("binary")


def _sketch(found: np.ndarray) -> np.ndarray:
    """Two bits of what each coordinate holds, 32 coordinates to a number.

    A dart's last bits tell only its coordinate, so these are the first ones.
    """
    bits = np.zeros(-(-len(found) // _PER_LONG) * _PER_LONG, dtype=np.uint64)
    bits[: len(found)] = found >> np.uint64(62)
    shifts = np.arange(_PER_LONG, dtype=np.uint64) * np.uint64(2)
    return np.bitwise_or.reduce(bits.reshape(-1, _PER_LONG) << shifts, axis=1)


def signed(text: Column, size: int, rows: int, bands: int) -> Column:
    """A struct of the content's digest, as two numbers, the hashes of the bands, and the sketch; both empty without words."""

    @F.pandas_udf("h1 long, h2 long, bands array<long>, sketch array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, known = [], {}
            for value in batch:
                data = words.as_bytes(value)
                hashed, distinct, counts = shingles(data, size)
                digest = xxhash.xxh3_128_digest(hashed.tobytes())
                if digest not in known:
                    found = (np.empty(0, dtype=np.int64),) * 2
                    if len(distinct):
                        signature = darts.signature(distinct, counts.astype(float), rows * bands)
                        found = darts.bands(signature, rows).view(np.int64), _sketch(signature).view(np.int64)
                    known[digest] = (*np.frombuffer(digest, dtype="<i8").tolist(), *found)
                out.append(known[digest])
            yield pd.DataFrame(out, columns=["h1", "h2", "bands", "sketch"])

    return run(_prepared(text))


def _alike(a: str, b: str, size: int, similarity: float) -> Column:
    """Whether two sketches of ``size`` coordinates differ in so few that the pair may be similar enough."""
    differ = 0.75 * (1 - similarity)  # coordinates that differ agree in both bits one time in four
    most = size * differ + DEVIATIONS * (size * differ * (1 - differ)) ** 0.5
    odd, found = 0x5555555555555555, F.lit(0)
    for i in range(-(-size // _PER_LONG)):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        found = found + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(odd)))
    return found <= int(most)


def elements(text: Column, size: int) -> Column:
    """The weighted set as a plain one: a number for every occurrence of a shingle."""

    @F.pandas_udf("array<long>")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            out = []
            for value in batch:
                _, distinct, counts = shingles(words.as_bytes(value), size)
                nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                out.append(words.mixed(np.repeat(distinct, counts) + words.mixed(nth.astype(np.uint64))).view(np.int64))
            yield pd.Series(out)

    return run(_prepared(text))


def _links(pairs: DataFrame, sets: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes that are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("set").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("set").alias("set_b"))
    both = pairs.join(one, "a").join(two, "b")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(shared >= similarity * (F.size("set_a") + F.size("set_b") - shared)).select("a", "b")


def _meeting(sets: DataFrame, classes: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes of different classes that may be similar enough, by their rarest elements.

    ``sets`` has node and set, ``classes`` node and class. Elements are ordered by how many sets have them, then by
    number. Of a pair the smaller set (then the lower node) is met at its first ``n - ceil(2 s n / (1 + s)) + 1``
    elements, the greater at its first ``n - ceil(s n) + 1``.
    """
    each = sets.select("node", F.size("set").alias("n"), F.explode("set").alias("element"))
    rarity = each.groupBy("element").agg(F.count("*").alias("df"))
    # Elements of one set only take their places in the order but meet nothing, so they need no row of their own.
    shared = each.join(rarity.where("df > 1"), "element")
    own = shared.groupBy("node").agg(F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct("df", "element"))).alias("order"))
    reach = F.col("n") - F.ceil(F.lit(similarity) * F.col("n") - 1e-9) + 1
    alone = F.col("n") - F.size("order")
    own = own.select("node", "n", alone.alias("alone"), F.slice("order", 1, F.greatest(F.lit(0), reach - alone).cast("int")).alias("first"))
    own = own.join(classes, "node").select("node", "n", "class", "alone", F.posexplode("first").alias("place", "e"))
    own = stored(own.select("node", "n", "class", (F.col("alone") + F.col("place")).alias("place"), F.col("e.element").alias("element")), "rarest")
    least = 2 * similarity / (1 + similarity)
    short = own.where(F.col("place") <= F.col("n") - F.ceil(F.lit(least) * F.col("n") - 1e-9))
    one = short.select("element", *[F.col(c).alias(c + "_a") for c in ("node", "n", "class", "place")])
    two = own.select(F.col("element").alias("element_b"), *[F.col(c).alias(c + "_b") for c in ("node", "n", "class", "place")])
    first = (F.col("n_a") < F.col("n_b")) | ((F.col("n_a") == F.col("n_b")) & (F.col("node_a") < F.col("node_b")))
    most = F.least(F.col("n_a") - F.col("place_a"), F.col("n_b") - F.col("place_b"))
    enough = most >= F.lit(similarity / (1 + similarity)) * (F.col("n_a") + F.col("n_b")) - 1e-9
    sized = F.col("n_a") >= F.lit(similarity) * F.col("n_b") - 1e-9
    met = one.join(two, (F.col("element") == F.col("element_b")) & first & sized & enough & (F.col("class_a") != F.col("class_b")))
    return met.select(F.greatest("node_a", "node_b").alias("a"), F.least("node_a", "node_b").alias("b")).distinct()


def _classes(nodes: DataFrame, docs: DataFrame, size: int, similarity: float, coordinates: int) -> DataFrame:
    """``node`` and ``class`` of all nodes that are linked to another.

    ``nodes`` has node, bands and sketch, ``docs`` node and text.
    """
    rows = nodes.select(F.explode("bands").alias("band"), "node")
    shared = rows.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(rows.join(shared, "band"), "band-members")
    degrees = stored(members.groupBy("node").agg(F.sum("n").alias("degree")), "degrees")
    texts = docs.join(degrees.select("node"), "node", "left_semi").dropDuplicates(["node"])  # rows may repeat
    sets = stored(texts.select("node", elements(F.col("text"), size).alias("set")), "shingles")
    sketches = stored(nodes.select("node", "sketch").join(degrees.select("node"), "node", "left_semi"), "sketches")

    def sketched(df: DataFrame, node: str, name: str) -> DataFrame:
        return df.join(sketches.select(F.col("node").alias(node), F.col("sketch").alias(name)), node)

    # Each node with the best connected nodes of its bands.
    best = members.join(degrees, "node").groupBy("band").agg(F.max(F.struct("degree", "node")).alias("best"))
    pairs = members.join(best.select("band", F.col("best.node").alias("b")), "band").where("node <> b")
    pairs = pairs.select(F.greatest("node", "b").alias("a"), F.least("node", "b").alias("b")).distinct()
    alike = _alike("sketch_a", "sketch_b", coordinates, similarity)
    pairs = sketched(sketched(pairs, "a", "sketch_a"), "b", "sketch_b").where(alike).select("a", "b")
    compared = stored(pairs, "compared")
    links = stored(_links(compared, sets, similarity), "links")
    found = components(links)

    # Bands in which several classes meet: their nodes, by their rarest elements.
    placed = members.select("band", "node").join(found, "node", "left").select(
        "band", "node", F.coalesce("component", "node").alias("class")
    )
    placed = stored(placed, "placed")
    open_ = placed.groupBy("band").agg((F.min("class") != F.max("class")).alias("several")).where("several")
    classes = stored(placed.join(open_.select("band"), "band", "left_semi").select("node", "class").distinct(), "open-nodes")
    left = _meeting(sets.join(classes.select("node"), "node", "left_semi"), classes, similarity)
    left = stored(left.join(compared, ["a", "b"], "left_anti"), "compared")
    more = stored(_links(left, sets, similarity), "links")
    # Links among classes join the nodes of both.
    found = components(links.unionByName(more))
    return found.select("node", F.col("component").alias("class"))


def _marked(docs: DataFrame, text: str, doc_id: str, size: int, similarity: float, rows: int, bands: int) -> DataFrame:
    """``id``, ``text_hash``, ``rest_hash`` (of the other columns) and ``class_id`` of every row."""
    rest = [F.col(c) for c in docs.columns if c not in (text, doc_id)]
    keyed = docs.select(F.col(doc_id).cast("long").alias("id"), F.xxhash64(text).alias("text_hash"), F.xxhash64(F.lit(0), *rest).alias("rest_hash"),
                        F.col(text).alias("text"))
    signs = keyed.select("id", "text_hash", "rest_hash", signed(F.col("text"), size, rows, bands).alias("s"))
    marked = stored(signs.select("id", "text_hash", "rest_hash", "s.*"), "signatures")
    first = F.min(F.struct(F.isnull("id").alias("unnamed"), "id", "text_hash")).alias("first")
    content = marked.groupBy("h1", "h2").agg(first, F.first("bands").alias("bands"), F.first("sketch").alias("sketch"))
    content = content.select("h1", "h2", "first.id", "first.text_hash", "bands", "sketch")
    # A content is numbered by its least id, or by its digest if that id is another's least one too, or null.
    several = content.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 and id is not null").select("id", F.lit(True).alias("several"))
    named = F.col("id").isNotNull() & F.col("several").isNull()
    content = content.join(several, "id", "left").select(
        "h1", "h2", "id", "text_hash", F.when(named, F.col("id")).otherwise(F.col("h1")).alias("node"), named.alias("named"), "bands", "sketch"
    )
    content = stored(content, "contents")
    # One text for each node that has bands: of the row that is its first.
    wanted = content.where(F.size("bands") > 0).select(_filled("id"), F.isnull("id").alias("_none"), "text_hash", "node")
    texts = keyed.select(_filled("id"), F.isnull("id").alias("_none"), "text_hash", "text").join(wanted, ["_id", "_none", "text_hash"])
    found = _classes(content.select("node", "bands", "sketch"), texts.select("node", "text"), size, similarity, rows * bands)
    classes = stored(content.join(found, "node", "left").select("h1", "h2", "node", "named", F.coalesce("class", "node").alias("class")), "node-classes")
    # Digests are no class numbers if there is an id.
    least = classes.join(classes.where("not named").select("class").distinct(), "class", "left_semi").groupBy("class").agg(
        F.min(F.when(F.col("named"), F.col("node"))).alias("least")
    )
    classes = classes.join(least, "class", "left").select("h1", "h2", F.coalesce("least", "class").alias("class_id"))
    return marked.drop("bands", "sketch").join(classes, ["h1", "h2"])


def _filled(column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(0).cast("long")).alias("_id")


def near_copies(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE,
                similarity: float = SIMILARITY, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """A row for each row of ``docs`` with ``doc_id`` and ``class_id``: the least id that names a content of its class.

    A content is named by the least id of its rows. Of an id with several texts, each row has the class of its own
    text; if it is the least of more than one content it names none, and contents without a name, those of null ids
    too, have a hash for one. Such a hash is a class number only if the class has no id. Rows that repeat are in the
    same class. All texts without words, null and empty ones too, are equal. An empty table gives no rows.
    """
    marked = _marked(docs, text, doc_id, size, similarity, rows, bands)
    return marked.select(F.col("id").alias("doc_id"), "class_id")


def keep_one(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", size: int = SHINGLE,
             similarity: float = SIMILARITY, rows: int = ROWS, bands: int = BANDS) -> DataFrame:
    """One row of ``docs`` for each class, with all its columns: that of the least id, null ids last.

    Of rows equal in id and text one stays, chosen by a hash of the other columns. Rows are chosen by narrow columns;
    whole rows are shuffled once, to meet the choice.
    """
    marked = _marked(docs, text, doc_id, size, similarity, rows, bands)
    first = F.min(F.struct(F.isnull("id").alias("unnamed"), "id", "text_hash", "rest_hash")).alias("first")
    kept = stored(marked.groupBy("class_id").agg(first).select("first.*"), "kept")
    kept = kept.select(_filled("id"), F.col("unnamed").alias("_none"), F.col("text_hash").alias("_text"), F.col("rest_hash").alias("_rest"))
    rest = [F.col(c) for c in docs.columns if c not in (text, doc_id)]
    id_ = F.col(doc_id).cast("long")
    keys = ["_id", "_none", "_text", "_rest"]
    keyed = docs.select(
        F.struct(*docs.columns).alias("_row"), F.coalesce(id_, F.lit(0).cast("long")).alias("_id"), id_.isNull().alias("_none"),
        F.xxhash64(text).alias("_text"), F.xxhash64(F.lit(0), *rest).alias("_rest"),
    )
    # Equal rows meet in one place already, so numbering them shuffles nothing.
    place = Window.partitionBy(*keys).orderBy(F.lit(0))
    single = keyed.join(kept, keys).withColumn("_place", F.row_number().over(place)).where("_place = 1")
    return single.select("_row.*")
