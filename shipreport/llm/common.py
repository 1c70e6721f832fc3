"""Helpers the corpus operators share: row keys, storage, byte buffers and word hashes."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipreport.session import apply_settings, fresh_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

PACKAGE = Path(__file__).resolve().parents[1]
#: White space of the word contracts: space and the code points 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"
#: Bytes of text one numpy step works on; a single longer text is a step of its own.
STEP_BYTES = 1 << 20


def corpus_settings(spark: SparkSession) -> SparkSession:
    """The settings of the library, with tables taken as large as their files: texts pack little."""
    apply_settings(spark).conf.set("spark.sql.sources.fileCompressionFactor", "1.0")
    return spark


def query(name: str, sql: str | None = None):
    """Register a query of this subpackage, with its SQL twin where there is one."""

    def add(make: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return make(corpus_settings(spark), sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return run

    return add


def ship_code(spark: SparkSession) -> None:
    """Give the executors this package, once a session, however the driver came to import it."""
    context = spark.sparkContext
    if not getattr(context, "_shipreport_sent", False):
        folder = Path(tempfile.mkdtemp(prefix="shipreport-code-"))
        with zipfile.ZipFile(folder / "shipreport_code.zip", "w") as archive:
            for file in sorted(PACKAGE.rglob("*.py")):
                archive.write(file, file.relative_to(PACKAGE.parent))
        context.addPyFile(str(folder / "shipreport_code.zip"))
        context._shipreport_sent = True


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def keyed(docs: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(d, t, id, text, more..): the row key (d, t) and the text, null read as empty.

    d is the id (null becomes the least long) and t a hash of the text. Rows that
    agree in both have the same text, so they have the same result.
    """
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    key = F.coalesce(docs[id_col].cast("long"), F.lit(-(2**63)))
    return docs.select(key.alias("d"), F.xxhash64(text).alias("t"), docs[id_col].alias("id"), text.alias("text"),
                       *[docs[c] for c in more])


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write rows several later steps read to the shared folder, and continue from that table."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with the value computed once a row, also where `use` reads it inside a lambda."""
    return F.transform(F.array(value), use)[0]


# ---- byte buffers ---------------------------------------------------------------------------

_MIX1, _MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit words (the splitmix finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


#: A random 64-bit value for each byte, from a rule.
BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of the hash base and of its inverse, modulo 2**64."""
    if len(_powers["up"]) < n:
        size = max(n, 2 * STEP_BYTES)
        for name, base in (("up", _BASE), ("down", _INVERSE)):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"][:n], _powers["down"][:n]


class Hasher:
    """Hashes of any byte ranges of one buffer, each from two sums over the bytes before its ends."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=self.sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.down[start] + (end - start).astype(np.uint64) * _MIX2)

    def windows(self, width: int) -> np.ndarray:
        """The hash of every range of `width` bytes, by its start."""
        n = len(self.sums) - width
        return mix((self.sums[width:] - self.sums[:n]) * self.down[:n] + np.array([width], np.uint64) * _MIX2) if n > 0 else np.zeros(0, np.uint64)


def text_buffer(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column without nulls, and the offsets of its rows in them."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about STEP_BYTES."""
    data, offsets = text_buffer(column)
    row = 0
    while row < len(offsets) - 1:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP_BYTES, "right")) - 1)
        part = offsets[row : end + 1]
        yield row, end, data[part[0] : part[-1]], part - part[0]
        row = end


_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def words(data: np.ndarray, offsets: np.ndarray, lower: bool, gaps: np.ndarray = _SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, starts, row of each word) of all words of a run of rows; A-Z lower-cased on request.

    gaps: by byte value, what parts words.
    """
    gap = np.ones(len(data) + 1, bool)
    gap[:-1] = gaps[data]
    first = ~gap[:-1]
    first[1:] &= gap[:-2]
    last = ~gap[:-1] & gap[1:]
    inner = offsets[1:-1]
    inner = inner[(inner > 0) & (inner < len(data))]
    first[inner] |= ~gap[inner]  # a row's text ends its last word
    last[inner - 1] |= ~gap[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    hashes = Hasher(_LOWER[data] if lower else data)(start, end)
    return hashes, start, np.searchsorted(offsets, start, "right") - 1


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> Iterator[np.ndarray]:
    """For each row, its sorted distinct hashes of `size` words; of the whole sequence where it has fewer."""
    hashes, _, row = words(data, offsets, lower=True)
    bounds = np.searchsorted(row, np.arange(len(offsets)))
    for a, b in zip(bounds[:-1], bounds[1:]):
        n = min(size, b - a)
        if not n:
            yield np.zeros(0, np.uint64)
            continue
        part = np.full(b - a - n + 1, n, np.uint64)
        for k in range(n):
            part = mix(part * np.uint64(_BASE) + hashes[a + k : b - n + 1 + k])
        yield np.unique(part)
