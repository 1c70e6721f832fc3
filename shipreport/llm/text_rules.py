"""Quality rules: repetition and length, then the distance from what a language looks like.

Each text gets two histograms, of character classes and of common words. The corpus gives the
reference of each language: the summed histograms of the documents that pass the base rules.
A document whose Jensen-Shannon distance from its language's reference is too large is
rejected; histograms over too little text give no verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, documents, let, query, stored

GAPS = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
# Frequent function words of English, French, German and Spanish.
COMMON_WORDS = (
    "the of and to a in is that for it as with was on be by this are from or an at "
    "de la le et les des en un une du que dans pour qui sur est au pas avec par "
    "der die und das von zu den mit ist im ein eine auf dem für sich als nicht "
    "el los las y del se por con para su al lo como"
).split()
#: Character classes by pattern, counted outside white space; the rest is a class of its own.
CLASSES = {"lower": r"[a-z]", "upper": r"\p{Lu}", "accented": r"[\p{Ll}\p{Lo}&&[^a-z]]", "digit": r"\p{N}", "stop": r"[.,;:!?'\"()-]", "symbol": r"[\p{S}#*%&@\\/|_~^]"}
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def removed(text: Column, pattern: str) -> Column:
    """How many code points of the text match."""
    return F.length(text) - F.length(F.regexp_replace(text, pattern, ""))


def repeated_words(hashes: Column, width: int) -> Column:
    """Words inside windows of `width` words that occur twice or more, from an array of word hashes.

    Windows of a text are compared only if a distinct count shows that some repeat. Then they
    are sorted by (hash, place), equal neighbours give the repeated places, and the places in
    order give the covered words: each window adds what the one before has not covered.
    """
    places = F.sequence(F.lit(0), F.size(hashes) - width)

    def window(at: Column) -> Column:
        return F.xxhash64(*[F.get(hashes, at + k) for k in range(width)])

    def covered(at: Column) -> Column:
        return F.aggregate(F.sequence(F.lit(1), F.size(at)), F.lit(0), lambda n, i: n + F.least(
            F.lit(width), F.coalesce(F.get(at, i), F.lit(2**31 - 1)) - F.get(at, i - 1)))

    def repeats(grams: Column) -> Column:
        pairs = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        return let(pairs, lambda p: F.array_sort(F.transform(F.filter(
            F.transform(p, lambda x, i: F.struct(x["i"].alias("i"), (F.coalesce(x["g"] == F.get(p, i - 1)["g"], F.lit(False)) | F.coalesce(x["g"] == F.get(p, i + 1)["g"], F.lit(False))).alias("twice"))),
            lambda x: x["twice"]), lambda x: x["i"])))

    def count(grams: Column) -> Column:
        return F.when(F.size(F.array_distinct(grams)) == F.size(grams), 0).otherwise(let(repeats(grams), covered))

    return F.when(F.size(hashes) < width, 0).otherwise(let(F.transform(places, window), count)).cast("long")


def common_words(words: Column) -> Column:
    """How often each common word is among the words, in any case; words too long to be one are not lower-cased."""
    longest = max(map(len, COMMON_WORDS))
    found = F.transform(F.filter(words, lambda w: (F.length(w) <= longest) & F.lower(w).isin(*COMMON_WORDS)), F.lower)
    return let(found, lambda m: F.transform(F.array(*[F.size(m) - F.size(F.array_remove(m, w)) for w in COMMON_WORDS]), lambda n: n.cast("long")))


def measures(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """The base counts and both histograms of every row, from one pass over the texts."""
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit(""))
    text = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    rows = docs.select(docs[id_col].alias("id"), lang.alias("lang"), text.alias("text"))
    words = F.regexp_extract_all("text", F.lit(WORD), 0)
    lines = F.filter(F.split("text", "\n", -1), lambda x: x.rlike(WORD))
    counted = rows.select(
        "id", "lang",
        F.regexp_replace("text", GAPS, "").alias("solid"), F.length("text").alias("n_chars"),
        let(words, lambda w: F.struct(
            F.size(w).cast("long").alias("n"), let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: repeated_words(h, 5)).alias("again"),
            common_words(w).alias("hits"))).alias("w"),
        let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
    )
    classes = [removed(F.col("solid"), p).cast("long") for p in CLASSES.values()]
    return counted.select(
        "id", "lang", F.col("w.n").alias("n_words"), F.length("solid").cast("long").alias("word_chars"), removed(F.col("solid"), SYMBOLS).cast("long").alias("n_symbols"),
        "n_dup_lines", F.col("w.again").alias("n_repeat_words"), F.array(*classes).alias("classes"), F.col("w.hits").alias("hits"),
    )


def distance(mine: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2) of two histograms of counts, the last bin being the rest."""
    def part(p: Column, m: Column) -> Column:
        return F.when(p > 0, p * F.log2(p / m)).otherwise(0.0)

    def share(x: Column) -> Column:
        return let(F.aggregate(x, F.lit(0).cast("long"), lambda a, b: a + b), lambda n: F.transform(x, lambda v: v / F.greatest(n, F.lit(1))))

    halves = F.zip_with(share(mine), share(reference), lambda p, q: (part(p, (p + q) / 2) + part(q, (p + q) / 2)) / 2)
    return F.sqrt(F.greatest(F.aggregate(halves, F.lit(0.0), lambda a, b: a + b), F.lit(0.0)))


def with_rest(counts: Column, total: Column) -> Column:
    return F.concat(counts, F.array(F.greatest(total - F.aggregate(counts, F.lit(0).cast("long"), lambda a, b: a + b), F.lit(0).cast("long"))))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", min_chars: int = 200, min_words: int = 50,
                  max_class_distance: float = 0.25, max_word_distance: float = 0.4) -> DataFrame:
    """Base counts, base verdict, both distances and `kept` of every row.

    Texts below min_chars word characters get no class verdict, below min_words no word verdict;
    the same guards hold for a reference. Null texts count as empty, which fails the base rules.
    Rows without a language share one reference. Null ids stay null, repeated rows come out once
    a row, an empty table gives no rows; other columns are not read. The references are one row a
    language, summed before the shuffle; a language with most rows moves no texts.
    """
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    rows = stored(measures(docs, id_col, text_col, lang_col).withColumn("base_failed", failed), "rules")
    bins = [f"c{i}" for i in range(len(CLASSES))], [f"h{i}" for i in range(len(COMMON_WORDS))]
    sums = [F.sum(F.when(~F.col("base_failed"), F.col(a)[i])).alias(b) for a, names in zip(("classes", "hits"), bins) for i, b in enumerate(names)]
    total = [F.sum(F.when(~F.col("base_failed"), F.col(c))).alias(f"all_{c}") for c in ("word_chars", "n_words")]
    reference = rows.groupBy("lang").agg(*sums, *total).na.fill(0).select(
        "lang", with_rest(F.array(*bins[0]), F.col("all_word_chars")).alias("ref_classes"), with_rest(F.array(*bins[1]), F.col("all_n_words")).alias("ref_hits"), "all_word_chars", "all_n_words")
    joined = rows.join(reference, "lang")
    by_class = F.when((F.col("word_chars") >= min_chars) & (F.col("all_word_chars") >= min_chars), distance(with_rest(F.col("classes"), F.col("word_chars")), F.col("ref_classes")))
    by_word = F.when((F.col("n_words") >= min_words) & (F.col("all_n_words") >= min_words), distance(with_rest(F.col("hits"), F.col("n_words")), F.col("ref_hits")))
    kept = ~F.col("base_failed") & F.coalesce(F.col("class_distance") <= max_class_distance, F.lit(True)) & F.coalesce(F.col("word_distance") <= max_word_distance, F.lit(True))
    return joined.withColumn("class_distance", by_class).withColumn("word_distance", by_word).select(
        F.col("id").alias(id_col), *BASE, "base_failed", kept.alias("kept"), "class_distance", "word_distance")


def _sql() -> str:
    """The same verdicts in DuckDB's SQL, from long tables of (document, bin, count)."""
    plain = {"lower": "[a-z]", "upper": r"\p{Lu}", "digit": r"\p{N}", "stop": r"[.,;:!?''\"()-]", "symbol": r"[\p{S}#*%&@\\/|_~^]"}
    gone = "length(solid) - length(regexp_replace(solid, '{}', '', 'g'))"
    counts = {k: gone.format(v) for k, v in plain.items()} | {"accented": f"{gone.format('[a-z' + chr(92) + 'p{Ll}' + chr(92) + 'p{Lo}]')} - ({gone.format('[a-z]')})"}
    words = ", ".join(f"('{w}')" for w in COMMON_WORDS)
    side = lambda x: f"CASE WHEN {x} > 0 THEN {x} * log2({x} / ((p + q) / 2)) ELSE 0 END"
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS lang, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS ws, regexp_replace(text, '[\\x20\\x09-\\x0D]+', '', 'g') AS solid FROM d),
g AS (SELECT r, i, array_to_string(ws[i:i + 4], ' ') AS gram FROM (SELECT r, ws, unnest(range(1, len(ws) - 3)) AS i FROM w WHERE len(ws) >= 5)),
g2 AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM g),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM g2 WHERE n > 1) GROUP BY r),
ln AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(text, chr(10))) AS l FROM w) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
b AS (SELECT w.r, doc_id, lang, ws, solid, len(ws) AS n_words, length(solid) AS word_chars, {gone.format("[#*$%&|<>]")} AS n_symbols,
  coalesce(ln.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words FROM w LEFT JOIN rep USING (r) LEFT JOIN ln USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b),
c0 AS (SELECT r, lang, base_failed, word_chars AS total, unnest([{", ".join(f"{{'k': '{k}', 'n': {v}}}" for k, v in counts.items())}], recursive := true) FROM f),
c AS (SELECT r, lang, base_failed, total, k, n FROM c0 UNION ALL SELECT r, lang, base_failed, total, 'rest', greatest(total - sum(n), 0) FROM c0 GROUP BY r, lang, base_failed, total),
bins AS (SELECT * FROM (VALUES {words}) t(k)),
hw AS (SELECT r, x, count(*) AS n FROM (SELECT r, unnest(list_transform(ws, lambda y: lower(y))) AS x FROM f) WHERE x IN (SELECT k FROM bins) GROUP BY ALL),
h0 AS (SELECT f.r, lang, base_failed, n_words AS total, k, coalesce(n, 0) AS n FROM f CROSS JOIN bins LEFT JOIN hw ON hw.r = f.r AND x = k),
h AS (SELECT * FROM h0 UNION ALL SELECT r, lang, base_failed, total, '', greatest(total - sum(n), 0) FROM h0 GROUP BY r, lang, base_failed, total),
both_ AS (SELECT 'c' AS kind, * FROM c UNION ALL SELECT 'h', * FROM h),
ref AS (SELECT kind, lang, k, coalesce(sum(n) FILTER (NOT base_failed), 0) AS n FROM both_ GROUP BY ALL),
rt AS (SELECT kind, lang, sum(n) AS total FROM ref GROUP BY ALL),
pq AS (SELECT kind, r, total, rt_total, n / greatest(sum(n) OVER (PARTITION BY kind, r), 1) AS p, m / greatest(rt_total, 1) AS q FROM
  (SELECT b1.kind, b1.r, b1.total, b1.n, ref.n AS m, rt.total AS rt_total FROM both_ b1 JOIN ref ON ref.kind = b1.kind AND ref.lang = b1.lang AND ref.k = b1.k
   JOIN rt ON rt.kind = b1.kind AND rt.lang = b1.lang)),
js AS (SELECT kind, r, any_value(total) AS total, any_value(rt_total) AS rt_total, sqrt(greatest(sum(({side("p")} + {side("q")}) / 2), 0)) AS dist FROM pq GROUP BY kind, r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed
  AND NOT coalesce(jc.total >= 200 AND jc.rt_total >= 200 AND jc.dist > 0.25, false) AND NOT coalesce(jh.total >= 50 AND jh.rt_total >= 50 AND jh.dist > 0.4, false) AS kept
FROM f LEFT JOIN js jc ON jc.r = f.r AND jc.kind = 'c' LEFT JOIN js jh ON jh.r = f.r AND jh.kind = 'h'"""


@query("op8_quality_rules", _sql())
def op8(spark, sf_dir):
    return quality_rules(documents(spark, sf_dir)).drop("class_distance", "word_distance")
