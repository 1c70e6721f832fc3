"""Near-duplicate embeddings: links at cosine >= 0.93 among vectors of one label, components and link counts.

Method (pivot-permutation index): PIVOTS reference vectors are drawn from a bounded, hashed
sample of the vectors. Each vector is described by the PREFIX pivots nearest to it, in order,
and listed under every unordered pair of them (inverted lists keyed by pivot pairs, within its
label). Two vectors are candidates when they share such a pair, i.e. at least two of their
nearest pivots; a pair met under several keys is verified once. Every candidate is verified
by its exact cosine in doubles: no link below the threshold. The index may miss a pair whose
prefixes share fewer than two pivots; recall against brute force is measured in the tests.
(Single pivots with bands of angle, tried first, separate nothing in 64 dimensions, where
almost all vectors lie near 90 degrees from every pivot: lists of hundreds met pairwise.)

Exact copies (same label, equal components) are one node with a multiplicity, so a vector
repeated thousands of times forms no pairs at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import query, stored
from .near_dedup import components

#: Reference vectors of the index, drawn from the vectors of least hash (a bounded sample).
PIVOTS = 128
#: Nearest pivots that describe a vector; it is listed under each pair of them.
PREFIX = 4
LEAST_COSINE = 0.93


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def node_table(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): every row with its node key, and one node for each (label, vector) of valid rows."""
    v = F.transform(F.col(vector_col), lambda x: x.cast("double"))
    finite = F.forall(F.col("v"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec"), F.col(label_col).alias("label"), v.alias("v"))
    rows = rows.withColumn("valid", F.col("vec").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0) & F.coalesce(finite, F.lit(False)))
    rows = rows.withColumn("norm", F.when(F.col("valid"), F.sqrt(dot(F.col("v"), F.col("v")))))
    rows = rows.withColumn("valid", F.col("valid") & (F.col("norm") > 0)).withColumn("h", F.when(F.col("valid"), F.xxhash64("label", "v")))
    nodes = rows.where("valid").groupBy("h", "label", "v").agg(F.min("vec").alias("node"), F.count("*").alias("c"), F.any_value("norm").alias("norm"))
    return rows, nodes


def describe(nodes: DataFrame, pivots: list[list[float]]) -> DataFrame:
    """Each node's prefix (nearest pivots, nearest first) and its angle to each of them."""
    unit = F.transform("v", lambda x: x / F.col("norm"))
    near = F.array(*[F.struct((-dot(F.col("unit"), F.lit(p))).alias("minus"), F.lit(i).alias("pivot")) for i, p in enumerate(pivots)])
    described = nodes.withColumn("unit", unit).withColumn("near", F.slice(F.array_sort(near), 1, PREFIX))
    return described.withColumn("prefix", F.transform("near", lambda x: x["pivot"]))


def pivots_of(nodes: DataFrame) -> list[list[float]]:
    """PIVOTS unit vectors of the nodes of least hash; fewer where there are fewer nodes."""
    picked = nodes.orderBy("h", "node").limit(PIVOTS).select(F.transform("v", lambda x: x / F.col("norm")).alias("u")).collect()
    return [list(r["u"]) for r in picked]


def candidate_links(described: DataFrame) -> DataFrame:
    """(a, b, cosine) of verified links between nodes, each pair once."""
    pairs = F.array(*[F.struct(F.least(F.col("prefix")[i], F.col("prefix")[j]).alias("p"), F.greatest(F.col("prefix")[i], F.col("prefix")[j]).alias("q"))
                      for i in range(PREFIX) for j in range(i + 1, PREFIX)])
    listed = described.select("node", "label", "v", "norm", F.explode(F.array_distinct(F.filter(pairs, lambda x: x["q"].isNotNull()))).alias("key"))
    a = listed.select(*[F.col(c).alias(f"{c}_a") for c in listed.columns])
    b = listed.select(*[F.col(c).alias(f"{c}_b") for c in listed.columns])
    met = a.join(b, (F.col("label_a") == F.col("label_b")) & (F.col("key_a") == F.col("key_b")) & (F.col("node_a") < F.col("node_b")))
    cosine = dot(F.col("v_a"), F.col("v_b")) / (F.col("norm_a") * F.col("norm_b"))
    found = met.select(F.col("node_a").alias("a"), F.col("node_b").alias("b"), cosine.alias("cosine")).where(F.col("cosine") >= LEAST_COSINE)
    return found.dropDuplicates(["a", "b"])


def vector_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Only rows of equal, non-null labels are compared. Rows with a null id, null label, null or
    empty vector, a null or non-finite component or a zero vector link with nothing: n_links 0,
    component_id their own id (null for a null id). Repeated rows are vectors of their own and
    link with each other (cosine 1); an empty table gives no rows; other columns are not read.
    """
    rows, nodes = node_table(vectors, id_col, vector_col, label_col)
    nodes = stored(nodes, "vector-nodes")
    pivots = pivots_of(nodes)
    if not pivots:
        return rows.select(F.col("vec").alias(id_col), F.lit(0).cast("long").alias("n_links"), F.col("vec").alias("component_id"), F.lit(True).alias("kept"))
    found = stored(candidate_links(describe(nodes, pivots)), "vector-links")
    sizes = nodes.select("node", "c")
    linked = (found.join(sizes.withColumnRenamed("node", "b").withColumnRenamed("c", "c_b"), "b").select(F.col("a").alias("node"), F.col("c_b").alias("n"))
              .unionByName(found.join(sizes.withColumnRenamed("node", "a").withColumnRenamed("c", "c_a"), "a").select(F.col("b").alias("node"), F.col("c_a").alias("n"))))
    degree = linked.groupBy("node").agg(F.sum("n").alias("others"))
    roots = components(found.select("a", "b"))
    info = nodes.select("h", "label", "v", "node", "c").join(degree, "node", "left").join(roots, "node", "left")
    info = info.select("h", "label", "v", (F.col("c") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"), F.coalesce("root", "node").alias("component"))
    out = rows.join(info, ["h", "label", "v"], "left")
    component = F.when(F.col("valid"), F.col("component")).otherwise(F.col("vec"))
    return out.select(F.col("vec").alias(id_col), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      (F.col("vec") == component).alias("kept"))


@query("op12_vector_dedup")
def op12(spark, sf_dir):
    return vector_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
