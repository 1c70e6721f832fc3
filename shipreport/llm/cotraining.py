"""A quality classifier by co-training.

Two views of a document: its words, and what a page says about itself (language, source, length,
layout and the mix of characters). A logistic model of each view learns from a bounded sample of
labelled documents; in each round the rows one view is sure of are pseudo-labels for the other.
Both views are calibrated on labels held out, a last small model combines them, and all documents
are scored where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, DoubleType, FloatType, IntegerType, LongType, StructField, StructType

from .common import documents, query, ship_code, steps, words

#: Buckets words are hashed to, buckets of a language or source, and bins of a number.
BUCKETS, NAMES, BINS = 1 << 18, 64, 12
#: How far from chance (in standard deviations) a word's share of good documents must be to count.
TELLING = 4.0
NUMBERS = ("bytes", "words", "lines", "word_size", "line_size", "upper", "digit", "symbol", "stop", "wide", "repeated", "mark_end")

_WORDLESS = np.ones(256, bool)
_WORDLESS[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False


def _table(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.int64)
    out[list(chars)] = 1
    return out


_UPPER, _DIGIT = _table(bytes(range(65, 91))), _table(bytes(range(48, 58)))
_SYMBOL, _STOP = _table(b"#$%&*+/<=>@\\^_`{|}~[]"), _table(b".,;:!?")
_WIDE, _LINE = (np.arange(256) >= 128).astype(np.int64), _table(b"\n")


def features(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, word bucket) of the distinct words of a run of texts, and the numbers of each text."""
    rows = len(offsets) - 1
    hashes, _, row = words(data, offsets, True, _WORDLESS)
    pairs = np.unique((row.astype(np.uint64) << np.uint64(32)) | (hashes % np.uint64(BUCKETS)))
    at, bucket = (pairs >> np.uint64(32)).astype(np.int64), (pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)
    _, _, plain = words(data, offsets, False)
    n_words, distinct = np.bincount(plain, minlength=rows), np.bincount(at, minlength=rows)
    alnum = np.bincount(row, minlength=rows)

    def count(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate([[0], np.cumsum(table[data])])[offsets])

    size, lines = np.diff(offsets), count(_LINE) + 1
    share = np.maximum(size, 1)
    numbers = np.stack([np.log1p(size), np.log1p(n_words), np.log1p(lines), size / np.maximum(n_words, 1), np.log1p(size / lines), count(_UPPER) / share, count(_DIGIT) / share,
                        count(_SYMBOL) / share, count(_STOP) / share, count(_WIDE) / share, distinct / np.maximum(alnum, 1) ** 0.7, alnum / np.maximum(n_words, 1)], axis=1)
    return at, bucket, numbers.astype(np.float32)


def name_bucket(values: pa.Array) -> np.ndarray:
    """Bucket of a name, by the sum of its hashed words; nulls have bucket 0."""
    out = []
    for v in values.to_pylist():
        h = 0
        for byte in (v or "").encode():
            h = (h * 1099511628211 ^ byte) & 0xFFFFFFFFFFFFFFFF
        out.append(h % (NAMES - 1) + 1 if v is not None else 0)
    return np.array(out, np.int64)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def logistic(row: np.ndarray, column: np.ndarray, n: int, width: int, y: np.ndarray, weight: np.ndarray, ridge: float = 2e-4, passes: int = 150) -> np.ndarray:
    """Weights (the last is the bias) of a logistic model over 0/1 features, by scaled gradient steps."""
    w, seen = np.zeros(width + 1), np.zeros(width + 1)
    total = max(weight.sum(), 1.0)
    for k in range(passes):
        x = np.bincount(row, w[column], n) + w[-1]
        error = (sigmoid(x) - y) * weight
        g = np.append(np.bincount(column, error[row], width), error.sum()) / total
        g[:-1] += ridge * w[:-1]
        seen = 0.9 * seen + 0.1 * g * g if k else g * g
        w -= 0.15 / (1 + k / 60) * g / (np.sqrt(seen) + 1e-6)
    return w


def dense_logistic(x: np.ndarray, y: np.ndarray, passes: int = 40) -> np.ndarray:
    """Weights (the last is the bias) of a small logistic model, by Newton steps with a weak prior."""
    x = np.column_stack([x, np.ones(len(x))])
    w = np.zeros(x.shape[1])
    for _ in range(passes):
        p = sigmoid(x @ w)
        h = (x * (p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        step = np.linalg.solve(h, x.T @ (p - y) + 0.1 * w)
        w -= step * min(1.0, 4 / (np.abs(step).max() + 1e-9))
    return w


@dataclass
class View:
    """0/1 features of a sample: the rows and columns of the ones."""

    row: np.ndarray
    column: np.ndarray
    width: int

    def fit(self, n: int, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
        on = weight[self.row] > 0
        return logistic(self.row[on], self.column[on], n, self.width, y, weight)

    def score(self, n: int, w: np.ndarray) -> np.ndarray:
        return np.bincount(self.row, w[self.column], n) + w[-1]


@dataclass
class Model:
    """What scoring needs; a few MB whatever the corpus holds."""

    prior: float
    edges: np.ndarray = field(default_factory=lambda: np.zeros((len(NUMBERS), 0)))
    word_weights: np.ndarray | None = None
    page_weights: np.ndarray | None = None
    scales: tuple[np.ndarray, np.ndarray] | None = None
    combined: np.ndarray | None = None

    def page_columns(self, numbers: np.ndarray, lang: np.ndarray, source: np.ndarray) -> np.ndarray:
        bins = [np.searchsorted(e, numbers[:, k], "right") + k * (BINS + 1) for k, e in enumerate(self.edges)]
        base = len(NUMBERS) * (BINS + 1)
        return np.stack([*bins, base + lang, base + NAMES + source], axis=1)

    def join(self, text: np.ndarray, page: np.ndarray) -> np.ndarray:
        return np.column_stack([text, page, np.minimum(text, page)])

    def score(self, at, bucket, numbers, lang, source) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated chances of being good: by the words, by the page, and by both."""
        n = len(numbers)
        if self.combined is None:
            flat = np.full(n, self.prior)
            return flat, flat, flat
        text = np.bincount(at, self.word_weights[bucket], n) + self.word_weights[-1]
        page = self.page_weights[self.page_columns(numbers, lang, source)].sum(axis=1) + self.page_weights[-1]
        text, page = (x * s[0] + s[1] for x, s in zip((text, page), self.scales))
        both = self.join(text, page) @ self.combined[:-1] + self.combined[-1]
        return sigmoid(text), sigmoid(page), sigmoid(both)


PAGE_WIDTH = len(NUMBERS) * (BINS + 1) + 2 * NAMES


def train(sample: dict[str, np.ndarray], rounds: int, sure: float) -> Model:
    """Co-training on the sample: y is 1, 0 or -1 (no label); every fifth label is held out."""
    y, numbers = sample["y"].astype(np.float64), sample["numbers"]
    n = len(y)
    labelled = np.flatnonzero(y >= 0)
    if len(labelled) < 20 or len(np.unique(y[labelled])) < 2:
        return Model(float(y[labelled].mean()) if len(labelled) else 1.0)
    model = Model(float(y[labelled].mean()))
    held = labelled[::5]
    learn = np.setdiff1d(labelled, held)
    model.edges = np.stack([np.quantile(numbers[learn, k], np.linspace(0, 1, BINS + 2)[1:-1]) for k in range(len(NUMBERS))])
    # words whose share of good documents is far from chance
    row, bucket = sample["row"], sample["bucket"]
    mine = np.isin(row, learn)
    seen, good = np.bincount(bucket[mine], minlength=BUCKETS), np.bincount(bucket[mine], y[row[mine]], BUCKETS)
    p = y[learn].mean()
    telling = (seen >= 5) & (np.abs(good - p * seen) > TELLING * np.sqrt(seen * p * (1 - p)))
    number = np.cumsum(telling) - 1
    on = telling[bucket]
    views = [View(row[on], number[bucket[on]], int(telling.sum())),
             View(np.repeat(np.arange(n), len(NUMBERS) + 2), model.page_columns(numbers, sample["lang"], sample["source"]).ravel(), PAGE_WIDTH)]
    labels, weights = [y.copy(), y.copy()], [np.zeros(n), np.zeros(n)]
    for k in (0, 1):
        weights[k][learn] = 1.0
    pool = np.flatnonzero(y < 0)
    for _ in range(rounds):
        scales = []
        for view, target, weight in zip(views, labels, weights):
            s = view.score(n, view.fit(n, np.maximum(target, 0), weight))
            scales.append((s, dense_logistic(s[held][:, None], y[held])))
        chances = [sigmoid(s * c[0] + c[1]) for s, c in scales]
        for teacher, pupil in ((0, 1), (1, 0)):
            chance = chances[teacher][pool]
            certain = pool[(chance >= sure) | (chance <= 1 - sure)]
            labels[pupil][certain] = chances[teacher][certain] > 0.5
            weights[pupil][certain] = 0.3
    fitted = [v.fit(n, np.maximum(t, 0), w) for v, t, w in zip(views, labels, weights)]
    scores = [v.score(n, w) for v, w in zip(views, fitted)]
    model.scales = tuple(dense_logistic(s[held][:, None], y[held]) for s in scores)
    model.word_weights = np.zeros(BUCKETS + 1)
    model.word_weights[:-1][telling] = fitted[0][:-1]
    model.word_weights[-1] = fitted[0][-1]
    model.page_weights = fitted[1]
    joined = model.join(*(s * c[0] + c[1] for s, c in zip(scores, model.scales)))
    model.combined = dense_logistic(joined[held], y[held])
    return model


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
                good=None, max_labelled: int = 15_000, max_pool: int = 10_000, rounds: int = 3, sure: float = 0.98) -> Model:
    """Fit on at most max_labelled labelled and max_pool other documents, the ones with the least id hash.

    good: a column over labels that is true for documents to keep; by default quality is 1 and
    toxic is not. Rows without an id or a verdict are left out; of several labels of an id the
    worst counts. The sample bounds what reaches the driver; nothing else depends on it.
    """
    ship_code(docs.sparkSession)
    verdict = good if good is not None else (F.col("quality") == 1) & (F.coalesce(F.col("toxic"), F.lit(0)) != 1)
    known = labels.select(labels[id_col].alias("_id"), verdict.cast("int").alias("_y")).where("_id is not null and _y is not null").groupBy("_id").agg(F.min("_y").alias("_y"))
    chosen = known.orderBy(F.xxhash64("_id"), "_id").limit(max_labelled)
    ids = docs.select(docs[id_col].alias("_id")).where("_id is not null")
    pool = ids.join(known.select("_id"), "_id", "left_anti").distinct().orderBy(F.xxhash64("_id"), "_id").limit(max_pool).withColumn("_y", F.lit(-1))
    sample_ids = F.broadcast(chosen.unionByName(pool))  # at most max_labelled + max_pool rows of two numbers
    view = text_view(docs, text_col, lang_col, source_col, docs[id_col].alias("_id"))
    schema = StructType([StructField("_id", LongType()), StructField("_y", IntegerType()), StructField("buckets", ArrayType(IntegerType())),
                         StructField("numbers", ArrayType(FloatType())), StructField("lang", LongType()), StructField("source", LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, end, data, offsets in steps(batch.column("_text")):
                at, bucket, numbers = features(data, offsets)
                n = end - row
                edge = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=n))]).astype(np.int32)
                part = batch.slice(row, n)
                yield pa.RecordBatch.from_arrays([
                    part.column("_id").cast(pa.int64()), part.column("_y"), pa.ListArray.from_arrays(pa.array(edge), pa.array(bucket.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(np.arange(0, numbers.size + 1, len(NUMBERS), dtype=np.int32)), pa.array(numbers.ravel())),
                    pa.array(name_bucket(part.column("_lang"))), pa.array(name_bucket(part.column("_source")))], names=schema.names)

    found = view.join(sample_ids, "_id").select("_id", "_y", "_lang", "_source", "_text").mapInArrow(run, schema).toArrow().combine_chunks().sort_by("_id")
    buckets, numbers = found.column("buckets").combine_chunks(), found.column("numbers").combine_chunks()
    sizes = np.array(pa.compute.list_value_length(buckets).to_numpy(zero_copy_only=False), np.int64) if len(found) else np.zeros(0, np.int64)
    sample = {"y": found.column("_y").to_numpy(), "row": np.repeat(np.arange(len(found), dtype=np.int32), sizes), "bucket": buckets.flatten().to_numpy(zero_copy_only=False),
              "numbers": numbers.flatten().to_numpy(zero_copy_only=False).reshape(-1, len(NUMBERS)), "lang": found.column("lang").to_numpy(), "source": found.column("source").to_numpy()}
    return train(sample, rounds, sure)


def text_view(docs: DataFrame, text_col: str, lang_col: str, source_col: str, *more) -> DataFrame:
    return docs.select(*more, F.coalesce(docs[text_col].cast("string"), F.lit("")).alias("_text"), docs[lang_col].cast("string").alias("_lang"), docs[source_col].cast("string").alias("_source"))


SCORES = ("text_score", "page_score", "score")


def score_quality(docs: DataFrame, model: Model, columns: tuple[str, ...], text_col: str = "text", lang_col: str = "lang", source_col: str = "source", at_least: float = 0.4, only_kept: bool = False) -> DataFrame:
    """(columns.., text_score, page_score, score, kept) of every row, or only the columns of the rows kept.

    Where a column has such a name already, the new one starts with quality_. Scores are chances of being good. Null texts count as empty, null languages and sources as a
    name of their own; every row gets a score, ids aren't read. Repeated rows score alike; an
    empty table gives no rows. One pass, no shuffle. A model fitted without two kinds of labels
    gives every row the share of good ones (1 without labels).
    """
    ship_code(docs.sparkSession)
    own = [] if only_kept else [StructField(c if c not in columns else f"quality_{c}", BooleanType() if c == "kept" else DoubleType()) for c in (*SCORES, "kept")]
    schema = StructType([docs.schema[c] for c in columns] + own)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, source = name_bucket(batch.column(len(columns) + 1)), name_bucket(batch.column(len(columns) + 2))
            for row, end, data, offsets in steps(batch.column(len(columns))):
                scores = shared.value.score(*features(data, offsets), lang[row:end], source[row:end])
                kept = scores[2] >= at_least
                part = [batch.column(i).slice(row, end - row) for i in range(len(columns))]
                if only_kept:
                    yield pa.RecordBatch.from_arrays([c.filter(pa.array(kept)) for c in part], names=list(columns))
                else:
                    yield pa.RecordBatch.from_arrays([*part, *map(pa.array, scores), pa.array(kept)], names=schema.names)

    return text_view(docs, text_col, lang_col, source_col, *[docs[c] for c in columns]).mapInArrow(run, schema)


@query("op3_quality_classifier")
def op3(spark, sf_dir):
    docs = documents(spark, sf_dir)
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score_quality(docs, model, ("doc_id",))
