"""Near-duplicate documents by an LSH forest over MinHash signatures.

Documents with the same shingle set are one node. A node's signature is read in several orders
(each starts at another value and goes round); sorted by one order, nodes with a long common
prefix are neighbours. A region is what shares a prefix: it starts at DEPTH values, and where
more nodes share it than a task compares at once, the prefix grows until few enough do. All
nodes of such a region also meet the region's hub, the node that lies in the largest regions,
in chunks. Within a region the full shingle sets decide, in matrix blocks, and a region gives
only the links of a spanning forest. Components come from those links.

Hubs and longer prefixes join most of a crowded region. Where its nodes are then still in several
components, they are dealt into blocks, and all blocks that hold different components are compared
in pairs. In very large regions only blocks and nodes meet that can hold a link: of two sets that
are similar enough, the rarest shingles have one in common (prefix filter).

So a link of similarity 0.85 is missed only if no region holds it, with a chance of 2e-8.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from shipreport.session import cut

from .common import documents, keyed, mix, query, ship_code, shingle_sets, steps, stored

#: Values of a signature, sorted orders of it, and the values a region shares at first.
VALUES, ORDERS, DEPTH = 96, 24, 4
#: Depths a crowded region grows through, in two rounds.
DEEPER = ((6, 9, 13, 19), (28, 42, 64, 96))
#: Nodes, and shingles of them in all, that one comparison holds at most; nodes of a chunk that meets a hub.
NODES, SHINGLES, CHUNK = 512, 4_000_000, 256
#: Nodes of a region whose blocks of CHUNK all meet; nodes of a shingle that are paired one by one.
WHOLE, FEW = 4096, 16
#: Shingles hashed at once for a signature.
BLOCK = 1 << 12

_SEEDS = mix(np.arange(1, 2 * VALUES + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))
_FACTORS, _SHIFTS = _SEEDS[:VALUES, None] | np.uint64(1), _SEEDS[VALUES:, None]


def signature(shingles: np.ndarray) -> np.ndarray:
    """The smallest of 96 hashes over the set."""
    out = np.full(VALUES, 0xFFFFFFFF, np.uint64)
    for at in range(0, len(shingles), BLOCK):
        part = shingles[None, at : at + BLOCK] * _FACTORS
        part += _SHIFTS
        part >>= np.uint64(32)
        np.minimum(out, part.min(axis=1), out=out)
    return out.astype(np.uint32)


def set_name(shingles: np.ndarray) -> bytes:
    """128 bits that name a set."""
    if not len(shingles):
        return bytes(16)
    other = mix(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5))
    return np.array([np.add.reduce(mix(shingles)), np.add.reduce(other) ^ np.uint64(len(shingles))], np.uint64).tobytes()


def signed_documents(docs: DataFrame, width: int) -> DataFrame:
    """(d, t, n_shingles, name, signature) of every row."""
    schema = StructType([StructField("d", LongType()), StructField("t", LongType()), StructField("n_shingles", LongType()),
                         StructField("name", BinaryType()), StructField("signature", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in steps(batch.column(2)):
                sets = list(shingle_sets(data, offsets, width))
                signs = np.concatenate([signature(s) for s in sets]).view(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, len(signs) + 1, VALUES, dtype=np.int32)), pa.array(signs))
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(row, end - row) for i in (0, 1)), pa.array([len(s) for s in sets], pa.int64()),
                                                  pa.array([set_name(s) for s in sets], pa.binary()), lists], names=schema.names)

    return docs.select("d", "t", "text").mapInArrow(run, schema)


def prefix(order: int, depth: int):
    """A hash of the first `depth` values of an order."""
    return F.xxhash64(F.lit(order), *[F.get("signature", (order * DEPTH + k) % VALUES) for k in range(depth)])


def deeper(depths: tuple[int, ...]):
    """(level, up, key) for each depth: the hash of the first `depth` values of the order in `tree`, and that of the depth before."""
    around = F.slice(F.concat("signature", "signature"), F.col("tree") * DEPTH + 1, F.lit(VALUES))
    keys = [F.col("key"), *[F.xxhash64("tree", F.slice(around, 1, d)) for d in depths]]
    return F.explode(F.array(*[F.struct(F.lit(i).alias("level"), keys[i].alias("up"), keys[i + 1].alias("key")) for i in range(len(depths))]))


def counted(members: DataFrame) -> DataFrame:
    """Regions of two nodes or more: their size, shingles, and 128 bits that name their member set."""
    return members.groupBy("tree", "key").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("shingles"),
                                              F.bit_xor("node").alias("_a"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_b")).where("size > 1")


def distinct_groups(found: DataFrame) -> DataFrame:
    """One (tree, key) for each member set: many trees give the same small groups."""
    place = F.struct("tree", "key")
    return found.groupBy("size", "_a", "_b").agg(F.min(place).alias("x")).select("x.*")


def regions(nodes: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(region, node): the groups whose members are compared with one another; (tree, key, size, node, n_shingles): those of crowded regions."""
    trees = F.explode(F.array(*[F.struct(F.lit(o).alias("tree"), prefix(o, DEPTH).alias("key")) for o in range(ORDERS)]))
    placed = nodes.select("node", "n_shingles", trees.alias("x")).select("node", "n_shingles", "x.*")
    fits = (F.col("size") <= NODES) & (F.col("shingles") <= SHINGLES)
    found = cut(counted(placed))
    once = distinct_groups(found.where(fits))
    groups = [placed.join(once, ["tree", "key"]).select(F.xxhash64("tree", "key").alias("region"), "node")]
    # small tables are stored: Spark then knows their size and doesn't deal out all nodes to meet them
    crowded = stored(found.where(~fits).select("tree", "key", "size"), "crowded")
    if crowded.isEmpty():
        return groups[0], None
    inside = stored(placed.join(crowded, ["tree", "key"]), "inside")
    weight = inside.groupBy("node").agg(F.sum("size").alias("weight"))
    hubs = inside.join(weight, "node").groupBy("tree", "key").agg(F.max_by("node", F.struct("weight", -F.col("node"))).alias("hub"), F.first("size").alias("size"))
    hubs = cut(hubs.withColumn("chunks", F.ceil(F.col("size") / CHUNK)))
    # regions with the same hub are met once: a node joins the hub's chunks a single time
    spread = hubs.groupBy("hub").agg(F.max("chunks").alias("chunks"))
    meets = inside.join(hubs.select("tree", "key", "hub"), ["tree", "key"]).select("hub", "node").distinct().join(spread, "hub")
    chunk = F.xxhash64(F.lit("hub"), "hub", F.pmod(F.xxhash64("node"), "chunks"))
    groups.append(meets.where("hub <> node").select(chunk.alias("region"), "node"))
    groups.append(spread.select("hub", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("c")).select(F.xxhash64(F.lit("hub"), "hub", "c").alias("region"), F.col("hub").alias("node")))
    signatures = nodes.select("node", "signature").join(inside.select("node").distinct(), "node", "left_semi")
    rest = cut(inside.select("tree", "key", "node", "n_shingles").join(signatures, "node"))
    for depths in DEEPER:
        deep = cut(rest.select("tree", "node", "n_shingles", deeper(depths).alias("x")).select("tree", "node", "n_shingles", "x.*"))
        found = deep.groupBy("tree", "level", "key").agg(F.any_value("up").alias("up"), F.count("*").alias("size"), F.sum("n_shingles").alias("shingles"),
                                                         F.bit_xor("node").alias("_a"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("_b")).where("size > 1")
        found = cut(found)
        crowded = found.where(~fits).select("tree", "level", "key")
        # inside a group that fits, deeper ones give nothing new
        above = crowded.select("tree", (F.col("level") + 1).alias("level"), F.col("key").alias("up"))
        first = found.where(fits).join(above, ["tree", "level", "up"], "left_semi").unionByName(found.where(fits & (F.col("level") == 0)))
        place = F.struct("tree", "level", "key")
        once = first.groupBy("size", "_a", "_b").agg(F.min(place).alias("x")).select("x.*")
        groups.append(deep.join(once, ["tree", "level", "key"]).select(F.xxhash64("tree", "key", F.lit(depths[0]), "level").alias("region"), "node"))
        crowded = crowded.where(F.col("level") == len(depths) - 1)
        if crowded.isEmpty():
            break
        last = deep.join(crowded, ["tree", "level", "key"]).select("tree", "key", "node", "n_shingles")
        rest = last.join(rest.select("tree", "node", "signature"), ["tree", "node"])
    out = groups[0]
    for more in groups[1:]:
        out = out.unionAll(more)
    return out, inside


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of a region's sets, in blocks of shingles that two sets or more share."""
    every = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], owner[order]
    new = np.ones(len(every), bool)
    new[1:] = every[1:] != every[:-1]
    shared = np.add.reduceat(np.ones(len(every), np.int64), np.flatnonzero(new)) > 1 if len(every) else np.zeros(0, bool)
    group = np.cumsum(new) - 1
    keep = shared[group]
    owner, column = owner[keep], (np.cumsum(shared) - 1)[group[keep]]
    out = np.zeros((len(sets), len(sets)), np.float32)
    step = max(1, (1 << 21) // len(sets))
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, step):
        a, b = np.searchsorted(column, [at, at + step])
        block = np.zeros((len(sets), step), np.float32)
        block[owner[a:b], column[a:b] - at] = 1
        out += block @ block.T
    return out


def forest(a: np.ndarray, b: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Of the links (a, b), those that join parts not joined yet."""
    root = list(range(n))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist()):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def links(docs: DataFrame, nodes: DataFrame, groups: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): links that join a region's similar nodes, confirmed on the full sets."""
    wanted = nodes.select("node", "rep_d", "rep_t").join(groups.select("node"), "node", "left_semi")
    texts = docs.select("d", "t", "text").join(wanted, (F.col("d") == F.col("rep_d")) & (F.col("t") == F.col("rep_t"))).select("node", "text")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in steps(batch.column(1)):
                raw = [s.tobytes() for s in shingle_sets(data, offsets, width)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), pa.array(raw, pa.binary())], names=["node", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, bytes]] = []
        region, out = None, []

        def close() -> None:
            if len(held) < 2:
                return
            sets = [np.frombuffer(x, np.uint64) for _, x in held]
            if len(sets) == 2:
                both = len(np.intersect1d(*sets, assume_unique=True))
                if 100 * both >= percent * (len(sets[0]) + len(sets[1]) - both):
                    out.append((held[0][0], held[1][0]))
                return
            both = overlaps(sets)
            size = np.array([len(x) for x in sets], np.float64)
            a, b = np.nonzero(np.triu(100 * both >= percent * (size[:, None] + size[None, :] - both), 1))
            out.extend((held[x][0], held[y][0]) for x, y in forest(a, b, len(sets)))

        def found() -> pa.RecordBatch:
            pairs = pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])
            out.clear()
            return pairs

        for batch in batches:
            for r, node, raw in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if r != region:
                    close()
                    held.clear()
                    region = r
                if not held or held[-1][0] != node:  # a repeated row brings its set again
                    held.append((node, raw))
            yield found()
        close()
        yield found()

    shipped = texts.mapInArrow(sets, "node long, shingles binary")
    sorted_ = groups.join(shipped, "node").select("region", "node", "shingles").repartition("region").sortWithinPartitions("region", "node")
    return sorted_.mapInArrow(compare, "a long, b long").distinct()


def dealt(open_: DataFrame) -> DataFrame:
    """(node, block): nodes of several components in blocks of about CHUNK, those of one component and region together."""
    home = open_.groupBy("node").agg(F.first("root").alias("root"), F.first("n_shingles").alias("n_shingles"), F.max(F.struct("size", "tree", "key")).alias("home"))
    parts = home.groupBy("home", "root").agg(F.count("*").alias("size"), F.sum("n_shingles").alias("shingles"))
    chunks = F.ceil(F.greatest(F.col("size") / CHUNK, F.col("shingles") / (SHINGLES / 2)))
    parts, large = parts.withColumn("chunks", chunks), F.col("chunks") > 1
    small = parts.where(~large).groupBy("home").agg(F.sum("size").alias("size"), F.sum("shingles").alias("shingles")).select("home", chunks.alias("all_small"))
    parts = parts.join(small, "home", "left").select("home", "root", "chunks", "all_small")
    block = F.when(large, F.xxhash64("home", "root", F.pmod(F.xxhash64("node"), "chunks"))).otherwise(F.xxhash64("home", F.pmod(F.xxhash64("root"), "all_small")))
    return stored(home.join(parts, ["home", "root"]).select("node", block.alias("block")), "blocks")


def mixed_blocks(cells: DataFrame, *by: str) -> DataFrame:
    """(x, y): blocks that meet under a key and are not of one component there; a block with itself, too."""
    a, b = (cells.select(*by, *[F.col(c).alias(f"{c}_{side}") for c in ("block", "low", "high")]) for side in "xy")
    return a.join(b, list(by)).where("block_x <= block_y and (low_x <> high_x or low_x <> low_y or low_y <> high_y)").select(F.col("block_x").alias("x"), F.col("block_y").alias("y")).distinct()


def open_pairs(docs: DataFrame, nodes: DataFrame, crowded: DataFrame, roots: DataFrame, width: int, percent: int) -> DataFrame | None:
    """(region, node): what is left to compare, nodes of one crowded region in different components, as pairs of blocks.

    A set travels once for each block its own meets, not for each pair. In regions of up to WHOLE nodes
    all blocks meet that are not of one component; in larger ones, those the rare shingles lead to.
    """
    rooted = crowded.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    several = rooted.groupBy("tree", "key").agg(F.min("root").alias("_a"), F.max("root").alias("_b")).where("_a <> _b").select("tree", "key")
    open_ = stored(rooted.join(several, ["tree", "key"], "left_semi"), "open")
    if open_.isEmpty():
        return None
    blocks = dealt(open_)
    ends = (F.min("root").alias("low"), F.max("root").alias("high"))
    met = mixed_blocks(open_.where(F.col("size") <= WHOLE).join(blocks, "node").groupBy("tree", "key", "block").agg(*ends), "tree", "key")
    vast = stored(open_.where(F.col("size") > WHOLE).select("node", "root", F.col("n_shingles").alias("n")).distinct().join(blocks, "node"), "vast")
    apart = None
    if not vast.isEmpty():
        behind, small = rare_shingles(docs, nodes, vast, width, percent)
        met = met.union(mixed_blocks(behind.where(F.col("often") > FEW).groupBy("shingle", "block").agg(*ends), "shingle"))
        a, b = (x.where(F.col("often") <= FEW).select("shingle", *[F.col(c).alias(f"{c}_{side}") for c in ("node", "root", "n", "block")]) for x, side in ((small, "a"), (behind, "b")))
        pairs = a.join(b, "shingle").where(f"root_a <> root_b and (n_a < n_b or n_a = n_b and node_a < node_b) and 100 * n_a >= {percent} * n_b")
        apart = pairs.select(F.least("block_a", "block_b").alias("x"), F.greatest("block_a", "block_b").alias("y"), F.explode(F.array("node_a", "node_b")).alias("node"))
    met = met.distinct().select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    out = met.join(blocks, "block").select("x", "y", "node")
    out = out if apart is None else out.union(apart).distinct()
    return out.select(F.xxhash64(F.lit("blocks"), "x", "y").alias("region"), "node")


def rare_shingles(docs: DataFrame, nodes: DataFrame, vast: DataFrame, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """(shingle, node, root, n, block, place, often) that two similar sets of different components share one of; those of the smaller set.

    Shingles are ordered from rare to frequent. If a and b have percent/100 of their union in common and
    a isn't larger, one of the first |a| - ceil(2 p |a| / (100 + p)) + 1 of a is among the first
    |b| - ceil(p |b| / 100) + 1 of b. What all texts of a template share lies behind these.
    """
    wanted = stored(nodes.select("node", "rep_d", "rep_t").join(vast.select("node"), "node", "left_semi"), "wanted")
    texts = docs.select("d", "t", "text").join(wanted, (F.col("d") == F.col("rep_d")) & (F.col("t") == F.col("rep_t"))).select("node", "text").dropDuplicates(["node"])

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in steps(batch.column(1)):
                sets = list(shingle_sets(data, offsets, width))
                names = np.repeat(batch.column(0).slice(row, end - row).to_numpy(zero_copy_only=False), [len(x) for x in sets])
                yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(np.concatenate(sets).view(np.int64))], names=["node", "shingle"])

    every = stored(texts.mapInArrow(explode, "node long, shingle long"), "shingles")
    often = every.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1")
    # shingles of one node are its rarest and find nothing: they only take places
    ranked = every.join(often, "shingle").join(vast, "node")
    window = Window.partitionBy("node")
    place = F.col("n") - F.count("*").over(window) + F.row_number().over(window.orderBy("often", "shingle"))
    behind = ranked.withColumn("place", place).where(f"place <= n - ceil({percent} * n / 100D - 1e-9) + 1").drop("often")
    mixed = behind.groupBy("shingle").agg(F.min("root").alias("_a"), F.max("root").alias("_b"), F.count("*").alias("often")).where("_a <> _b").select("shingle", "often")
    behind = stored(behind.join(mixed, "shingle"), "rare")
    return behind, behind.where(f"place <= n - ceil(2D * {percent} * n / (100 + {percent}) - 1e-9) + 1")


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node each node of an edge is joined with.

    Alternates two steps until nothing changes: larger neighbours of a node move to its smallest
    neighbour, then a node and its smaller neighbours do. Edges shrink to stars; a hub's
    neighbours are reduced to their minimum before any shuffle.
    """
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(lowest, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").where("u <> v").distinct()
        edges = cut(small)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """(d, t, id, n_shingles, component_id, group) of every row; component_id is the smallest id joined with it.

    group names the component, also where it has no id; it is null for a row without a set.

    Words split at ASCII white space, A-Z count as a-z; a set holds the distinct runs of `width`
    words, or the whole sequence of fewer. Rows link at 100 * intersection >= percent * union.
    Null, empty and blank texts have no set and link with nothing: their component is their id.
    Null ids link like others; where all ids of a component are null, so is component_id.
    Repeated rows come out once a row, rows of one id with other texts are documents of their
    own, an empty table gives no rows; other columns are not read. Equal sets are one node.
    """
    ship_code(docs.sparkSession)
    rows = keyed(docs, id_col, text_col)
    signed = stored(signed_documents(rows, width), "signatures")
    least = F.lit(-(2**63))
    nodes = signed.where("n_shingles > 0").groupBy("name").agg(
        F.min(F.when(F.col("d") != least, F.col("d"))).alias("first"), F.min(F.struct("d", "t")).alias("rep"), F.any_value("n_shingles").alias("n_shingles"), F.any_value("signature").alias("signature"))
    nodes = stored(nodes.select("name", F.xxhash64("name").alias("node"), "first", F.col("rep.d").alias("rep_d"), F.col("rep.t").alias("rep_t"), "n_shingles", "signature"), "nodes")
    groups, crowded = regions(nodes)
    found = links(rows, nodes, stored(groups, "regions"), width, percent)
    if crowded is None:
        roots = components(found)
    else:
        found = stored(found, "links")
        roots = components(found)
        rest = open_pairs(rows, nodes, crowded, roots, width, percent)
        if rest is not None:
            few = nodes.select("node", "rep_d", "rep_t").join(crowded.select("node"), "node", "left_semi")
            roots = components(found.unionAll(links(rows, stored(few, "few"), stored(rest, "rest"), width, percent)))
    named = nodes.select("name", "node", "first").join(roots, "node", "left").select("name", "first", F.coalesce("root", "node").alias("root"))
    best = named.groupBy("root").agg(F.min("first").alias("component"))
    labels = named.join(best, "root").select("name", "root", "component")
    out = signed.select("d", "t", "n_shingles", "name").join(labels, "name", "left")
    row_id = F.when(F.col("d") != least, F.col("d")).cast(docs.schema[id_col].dataType)
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.when(F.col("d") != least, F.col("d")))
    return out.select("d", "t", row_id.alias("id"), "n_shingles", component.alias("component_id"), F.col("root").alias("group"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of docs with one row for each group of near duplicates, the one with the least id (null last).

    Rows without a set all stay. Columns of any name stay as they are.
    """
    least = F.lit(-(2**63))
    found = near_duplicates(docs, id_col, text_col, **how)
    order = F.struct((F.col("d") == least).alias("null_id"), "d", "t")
    single = found.where("group is not null").groupBy("group").agg(F.min(order).alias("x")).select("x.d", "x.t", F.lit(True).alias("_single"))
    keys = single.unionByName(found.where("group is null").select("d", "t", F.lit(False).alias("_single")).distinct()).withColumnsRenamed({"d": "_d", "t": "_t"})
    rows = keyed(docs.select(id_col, text_col, F.struct("*").alias("_row")), id_col, text_col, "_row").select(F.col("d").alias("_d"), F.col("t").alias("_t"), "_row")
    kept = rows.join(keys, ["_d", "_t"]).withColumn("_n", F.row_number().over(Window.partitionBy("_d", "_t").orderBy("_d")))
    return kept.where("_n = 1 or not _single").select("_row.*")


@query("op6_near_dedup")
def op6(spark, sf_dir):
    found = near_duplicates(documents(spark, sf_dir), width=3, percent=85)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", (F.col("id") == F.col("component_id")).alias("kept"))
