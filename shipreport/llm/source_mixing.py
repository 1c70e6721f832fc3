"""Mixing sources to target weights by pivotal dependent rounding.

Every document of a source wants the same number of copies, the source's target over its size;
the fraction of it is a probability. Two units at a time, words move from one to the other at
random until one of them is whole. Expectations and the words of each source stay as they were.
In a pair the smaller unit settles, so plain pairs would leave the largest document open. Chunks
of a source therefore go largest first, each document against the pool of all later ones; a chunk
leaves one small document open. Those go up a tree of pairs, and the last is rounded by its chance.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipreport.session import cut

from .common import WORD, documents, keyed, mix, query, ship_code

#: The weights of the sources in their order, repeating.
WEIGHTS = (5, 2, 1)
#: Documents of a source rounded in one chunk, on average, and chunks that meet in a node of the tree.
CHUNK, FAN_IN = 4096, 64


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, n, source_size, target): the budget shared by weight, each target capped at `most` times its source.

    One row a source. The common factor of the uncapped targets comes from whole-number sums in
    a few rounds; only those sums reach the driver.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    sources = cut(sizes.groupBy("source").agg(F.count("*").alias("n"), F.sum("size").alias("source_size"))
                  .withColumn("weight", F.get(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights))))
    budget = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    factor = 0.0
    while True:
        over = F.lit(factor) * F.col("weight") > most * F.col("source_size")
        capped, free, n = sources.agg(F.sum(F.when(over, F.col("source_size"))), F.sum(F.when(~over, F.col("weight"))), F.count_if(over)).first()
        new = max(0.0, budget - most * (capped or 0)) / free if free else factor
        if new <= factor:
            break
        factor = new
    return sources.withColumn("target", F.least(F.lit(factor) * F.col("weight"), most * F.col("source_size")))


#: Columns of the rounding: part is the open fraction, copies the whole ones.
COLUMNS = {"source": "object", "chunk": "int64", "d": "int64", "t": "int64", "null_id": "bool", "size": "int64", "part": "float64", "copies": "int64", "settled": "bool"}


class Open:
    """A document that may still hold a fraction."""

    __slots__ = ("row", "size", "part", "copies", "settled")

    def __init__(self, row: tuple):
        self.row, self.size, self.part, self.copies, self.settled = row[:5], row[5], row[6], row[7], row[8]

    def end(self, up: bool) -> None:
        self.part, self.copies, self.settled = 0.0, self.copies + up, True


def meet(a: Open, b: Open, u: float) -> tuple[Open, Open]:
    """Move words between two fractions until one is whole; returns (settled, still open)."""
    rise, fall = (1 - a.part) * a.size, a.part * a.size
    up, down = min(rise, b.part * b.size), min(fall, (1 - b.part) * b.size)
    if u * (up + down) < down:  # a gains
        done, whole = (a, True) if rise <= up else (b, False)
        a.part, b.part = a.part + up / a.size, b.part - up / b.size
    else:
        done, whole = (a, False) if fall <= down else (b, True)
        a.part, b.part = a.part - down / a.size, b.part + down / b.size
    done.end(whole)
    rest = b if done is a else a
    rest.part = min(max(rest.part, 0.0), 1.0)
    return done, rest


def settle(level: int, root: bool):
    """One pass over rows sorted by source and chunk, with at most one open document in memory."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, group, chance = None, None, 0.0
        pool, part = 0, 0.0  # words of the chunk's documents to come, and their common fraction

        def frame(docs: list[Open]) -> pd.DataFrame:
            rows = [(*x.row, x.size, x.part, x.copies, x.settled) for x in docs]
            return pd.DataFrame({c: pd.Series([r[i] for r in rows], dtype=kind) for i, (c, kind) in enumerate(COLUMNS.items())})

        def close(x: Open) -> Open:
            if root and not x.settled:
                x.end(chance < x.part)
            return x

        for batch in batches:
            seeds = batch["luck"].to_numpy().astype(np.int64).view(np.uint64)
            luck = (mix(seeds + np.uint64(level + 1)) >> np.uint64(11)).astype(np.float64) / (1 << 53)
            out = []
            for row, u, mass in zip(batch[list(COLUMNS)].itertuples(index=False, name=None), luck, batch["mass"]):
                x = Open(row)
                if x.settled:
                    out.append(x)
                    continue
                if group != row[:2]:
                    if held is not None:
                        out.append(close(held))
                    held, group, chance = None, row[:2], u
                    pool, part = mass, x.part
                chance = (chance + u) % 1.0
                if level:
                    if held is not None:
                        done, x = meet(held, x, u)
                        out.append(done)
                    held = x
                    continue
                pool -= x.size
                x.part = part
                if part <= 1e-12 or part >= 1 - 1e-12:
                    x.end(part > 0.5)
                elif pool > 0:
                    done, rest = meet(x, Open((*row[:5], pool, part, 0, False)), u)
                    part = rest.part if done is x else float(done.copies)
                if x.settled:
                    out.append(x)
                else:
                    held = x
            yield frame(out)
        if held is not None:
            yield frame([close(held)])

    return run


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", seed: int = 42, **targets) -> DataFrame:
    """(d, t, id, source, size, source_size, target, copies): how often the mix takes each row.

    A text's size is its number of words; nulls and empty texts have none and are never needed,
    but they count as whole copies of their source's floor. Null sources are one source, the
    last. Null ids stay null and repeated rows are rounded each for itself. An empty table gives
    no rows. Rows go by a hash of id and text, so reruns agree whatever the partitions.
    A chunk passes through a task as a sorted stream with one open row in memory.
    """
    ship_code(docs.sparkSession)
    rows = keyed(docs, id_col, text_col, source_col)
    sizes = rows.select("d", "t", "id", F.col(source_col).cast("string").alias("source"), F.regexp_count("text", F.lit(WORD)).cast("long").alias("size"))
    sizes = cut(sizes)
    sources = cut(source_targets(sizes, **targets)).drop("weight")
    ratio = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    largest = sources.agg(F.max("n")).first()[0] or 0
    levels = 1 + max(0, math.ceil(math.log(max(1, math.ceil(largest / CHUNK)), FAN_IN)))
    keys = sources.select(F.col("source").alias("_source"), "n", "source_size", "target")
    joined = sizes.join(keys, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
    part = ratio - F.floor(ratio)
    rows = joined.select(
        "source", F.pmod(F.xxhash64("d", "t"), F.greatest(F.ceil(F.col("n") / CHUNK), F.lit(1))).alias("chunk"), "d", "t", F.isnull("id").alias("null_id"), "size",
        part.alias("part"), F.floor(ratio).alias("copies"), ((part <= 0) | (F.col("size") == 0)).alias("settled"))
    schema, done = rows.schema, None
    for level in range(levels):
        if not level:  # words of the open documents of each chunk: a row a chunk
            masses = rows.where("not settled").groupBy("source", "chunk").agg(F.sum("size").alias("mass")).select(F.col("source").alias("_s"), F.col("chunk").alias("_c"), "mass")
            rows = rows.join(masses, F.col("source").eqNullSafe(F.col("_s")) & (F.col("chunk") == F.col("_c")), "left").drop("_s", "_c").fillna(0, ["mass"])
        else:
            rows = rows.withColumn("mass", F.lit(0).cast("long"))
        streams = rows.withColumn("luck", F.xxhash64("d", "t", F.lit(seed))).repartition("source", "chunk").sortWithinPartitions("source", "chunk", F.desc("size"), "luck", "d", "t")
        said = cut(streams.mapInPandas(settle(level, level == levels - 1), schema))
        settled = said.where("settled")
        done = settled if done is None else done.unionAll(settled)
        rows = said.where("not settled").withColumn("chunk", F.floor(F.col("chunk") / FAN_IN))
    back = done.join(keys, F.col("source").eqNullSafe(F.col("_source")))
    row_id = F.when(~F.col("null_id"), F.col("d")).cast(docs.schema[id_col].dataType)
    return back.select("d", "t", row_id.alias("id"), "source", "size", "source_size", "target", "copies")


def mixed_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The rows of docs as often as the mix takes them; columns of any name stay as they are."""
    taken = mix_sources(docs, id_col, text_col, source_col, **how).groupBy("d", "t").agg(F.sum("copies").alias("_copies"), F.count("*").alias("_rows")).where("_copies > 0").withColumnsRenamed({"d": "_d", "t": "_t"})
    rows = keyed(docs.select(id_col, text_col, F.struct("*").alias("_row")), id_col, text_col, "_row").select(F.col("d").alias("_d"), F.col("t").alias("_t"), "_row")
    # rows that agree in id and text share their copies, the first ones take one more
    place = F.row_number().over(Window.partitionBy("_d", "_t").orderBy("_d"))
    copies = F.expr("_copies div _rows") + (F.col("_n") <= F.col("_copies") % F.col("_rows")).cast("long")
    shared = rows.join(taken, ["_d", "_t"]).withColumn("_n", place).withColumn("_copies", copies).where("_copies > 0")
    return shared.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_copies")))).select("_row.*")


@query("op7_source_mixing")
def op7(spark, sf_dir):
    mixed = mix_sources(documents(spark, sf_dir))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
