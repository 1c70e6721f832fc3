"""Left lookups into reference tables.

No join is forced to broadcast. Reference files are read with known sizes, so
Spark broadcasts a small one by itself (spark.sql.autoBroadcastJoinThreshold)
and shuffles a large one; the reference side holds one row per key, so adaptive
execution can split a hot key of the fact side without touching the result.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F, types as T

from shipreport.functions.text import account_key, account_text, clean, code_key, col, zip_text
from shipreport.operators.asof import fill_forward
from shipreport.operators.dedup import first_per_key, require_unique
from shipreport.session import cut


def require_columns(table: DataFrame, names: list[str], what: str) -> DataFrame:
    missing = [n for n in names if n not in table.columns]
    if missing:
        raise ValueError(f"{what} lacks the columns {missing}")
    return table


def one_row_per_key(table: DataFrame, key: Column, take: dict[str, str], order: list[str] | None) -> DataFrame:
    """Key plus the wanted columns, first row per key; null keys never match and go.

    The first row is the first in ``order``, by default in the table's row order (row_idx) where it has one.
    """
    order = order or (["row_idx"] if "row_idx" in table.columns else sorted(set(take.values())))
    rows = table.select(key.alias("_k"), *[col(s).alias(n) for n, s in take.items()],
                        *[col(o).alias(f"_o{i}") for i, o in enumerate(order)]).where("_k is not null")
    marks = [f"_o{i}" for i in range(len(order))]
    return first_per_key(rows, ["_k"], marks).drop(*marks)


def attach(
    fact: DataFrame,
    table: DataFrame,
    fact_key: Column,
    table_key: Column,
    take: dict[str, str],
    *,
    order: list[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Left-join columns ``take`` (new name -> table column); clashing fact columns are replaced.

    ``unique`` says the table has one row per key already and skips the de-duplication.
    """
    if unique:
        side = table.select(table_key.alias("_k"), *[col(s).alias(n) for n, s in take.items()])
    else:
        side = one_row_per_key(table, table_key, take, order)
    kept = [c for c in fact.columns if c not in take]
    left = fact.select(*map(col, kept), fact_key.alias("_fk"))
    if "AWB" in kept and isinstance(left.schema["_fk"].dataType, T.StringType):
        # rows without a key match nothing; a value by waybill keeps them from meeting in one task
        spread = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(col("AWB")), F.lit(1024)).cast("string"))
        left = left.withColumn("_fk", F.coalesce("_fk", spread))
    return left.join(side, F.col("_fk") == F.col("_k"), "left").drop("_fk", "_k")


ZONE_ORIGIN = ["DEST", "3 LC", "NAMA KAB/KOTA", "NAMA KAB/KOTA 2", "REGION", "PROVINSI", "KODE POS"]
ZONE_DEST = ["DEST", "KECAMATAN", "NAMA KAB/KOTA", "PROVINSI", "KODE POS"]


def origin_lookup(fact: DataFrame, zones: DataFrame, **options) -> DataFrame:
    """City, province, region and zip of the origin."""
    require_columns(zones, ZONE_ORIGIN, "zone table")
    return attach(fact, zones, col("ORIGIN"), col("DEST"), {
        "3_LC_ORIGIN": "3 LC",
        "ORIGIN_CITY": "NAMA KAB/KOTA",
        "ORIGIN_CITY_2": "NAMA KAB/KOTA 2",
        "REGION": "REGION",
        "PROVINSI_ORIGIN": "PROVINSI",
        "KODE_POS_ORI": "KODE POS",
    }, **options)


def dest_lookup(fact: DataFrame, zones: DataFrame, *, order: list[str] | None = None) -> DataFrame:
    """District, city, province and zip of the destination.

    A missing zip is taken from the next higher code of the same prefix. That
    search runs on the distinct destination codes, which are stored once because
    the search reads them several times; the fact rows are joined once.
    """
    require_columns(zones, ZONE_DEST, "zone table")
    take = ["KECAMATAN", "NAMA KAB/KOTA", "PROVINSI", "KODE POS"]
    key = F.upper(F.trim(col("DEST")))
    known = one_row_per_key(zones, key, {c: c for c in take}, order)
    known = known.withColumn("KODE POS", zip_text(col("KODE POS")))
    codes = cut(fact.select(key.alias("_k")).where("_k is not null").distinct()).join(known, "_k", "left")
    filled = fill_forward(codes, "_k", "KODE POS", anchors=known)
    fact = fact.withColumn("DEST", key)
    return attach(fact, filled, col("DEST"), col("_k"), {c: c for c in take}, unique=True)


# Island group by region; every other region lies outside Java.
AREA_GROUPS = {
    "Regional Jakarta": "Jabodetabekcil",
    "Regional Bodetabekcil": "Jabodetabekcil",
    "Regional Jawa Barat": "Pulau Jawa",
    "Regional Jateng Diy": "Pulau Jawa",
}


def area_group(fact: DataFrame, zones: DataFrame, **options) -> DataFrame:
    require_columns(zones, ["DEST", "REGION"], "zone table")
    joined = attach(fact, zones, F.trim(col("DEST")), F.trim(col("DEST")), {"_region": "REGION"}, **options)
    group = F.lit("Luar Pulau Jawa")
    pairs = [F.lit(x) for pair in AREA_GROUPS.items() for x in pair]
    return joined.withColumn(
        "WILAYAH", F.coalesce(F.try_element_at(F.create_map(*pairs), F.col("_region")), group)).drop("_region")


def undelivered_reason(fact: DataFrame, codes: DataFrame, **options) -> DataFrame:
    require_columns(codes, ["Coding Undel", "Remark_Bahasa"], "undelivered-code table")
    return attach(fact, codes, code_key(col("CODING_UNDEL")), code_key(col("Coding Undel")),
                  {"REASON UNDEL": "Remark_Bahasa"}, **options)


# Result column of each attempt and the reason column it fills.
ATTEMPTS = {
    "RESULT_1ST_ATTEMPT": "REASON_1ST_ATTEMPT",
    "RESULT_2ND_ATTEMPT": "REASON_2ND_ATTEMPT",
    "RESULT_LAST_ATTEMPT": "REASON_LAST_ATTEMPT",
}


def attempt_reason(fact: DataFrame, codes: DataFrame, result: str) -> DataFrame:
    """Reason text of one attempt, for codes starting with U; ambiguous codes are an error."""
    require_columns(codes, ["Coding Undel", "Remark_Bahasa"], "undelivered-code table")
    pairs = codes.select(col("Coding Undel"), col("Remark_Bahasa")).where(col("Coding Undel").isNotNull()).distinct()
    checked = require_unique(pairs, "Coding Undel", "undelivered-code table")
    wanted = F.when(col(result).startswith("U"), col(result))
    return attach(fact, checked, wanted, col("Coding Undel"), {ATTEMPTS[result]: "Remark_Bahasa"}, unique=True)


def delivery_remark(fact: DataFrame, codes: DataFrame, **options) -> DataFrame:
    """Description of delivery codes (those starting with D)."""
    require_columns(codes, ["CODE", "STATUS"], "status-code table")
    wanted = F.when(col("CODING").startswith("D"), col("CODING"))
    return attach(fact, codes, wanted, col("CODE"), {"CODING_DELIVERY": "STATUS"}, **options)


def code_remark(fact: DataFrame, codes: DataFrame, **options) -> DataFrame:
    """Description of any code."""
    require_columns(codes, ["CODE", "STATUS"], "status-code table")
    return attach(fact, codes, col("CODING"), col("CODE"), {"CODING_REMARKS": "STATUS"}, **options)


def client_status(fact: DataFrame, statuses: DataFrame, **options) -> DataFrame:
    """Client-facing status, its group and note."""
    require_columns(statuses, ["Status", "Grouping BIG Status", "AJ Car Status", "KETERANGAN AJ CAR"], "status table")
    return attach(fact, statuses, col("STATUS_POD"), col("Status"), {
        "Remark Return": "Grouping BIG Status",
        "AJ Car Status": "AJ Car Status",
        "KETERANGAN AJ CAR": "KETERANGAN AJ CAR",
    }, **options)


def area_promise(fact: DataFrame, areas: DataFrame, **options) -> DataFrame:
    """Area and promise by region, and the carrier flag that follows from them."""
    require_columns(areas, ["REGION", "AREA MANDIRI", "SLA"], "area table")
    joined = attach(fact, areas, col("REGIONAL"), col("REGION"),
                    {"AREA MANDIRI": "AREA MANDIRI", "SLA OOB": "SLA"}, **options)
    late = col("SLA OOB") - col("AGING") < 0
    return joined.withColumn("CARRER", F.when(late, "Over SLA").otherwise("On Time SLA"))


def account_name(fact: DataFrame, accounts: DataFrame, *, order: list[str] | None = None, unique: bool = False) -> DataFrame:
    """Customer name by account; without a match the old name or the shipper group stays."""
    require_columns(accounts, ["CUST_ID", "CUST_NAME"], "account table")
    named = accounts.withColumn("_name", F.nullif(clean(col("CUST_NAME")), F.lit(""))).where("_name is not null")
    old = next((c for c in ("CUST_NAME", "GROUPING_SHIPPER") if c in fact.columns), None)
    joined = attach(fact, named, account_key(col("ID_ACCOUNT")), account_key(col("CUST_ID")),
                    {"_found": "_name"}, order=order, unique=unique)
    name = F.coalesce(F.col("_found"), col(old)) if old else F.col("_found")
    return joined.withColumn("CUST_NAME", name).drop("_found")


def account_label(fact: DataFrame, accounts: DataFrame, **options) -> DataFrame:
    """Account id and customer name in one text."""
    named = account_name(fact, accounts, **options)
    return named.withColumn("DEPT PZC", F.concat_ws(" ", col("ID_ACCOUNT"), col("CUST_NAME")))


def category_of_groups(groups: DataFrame, projects: DataFrame, industries: DataFrame | None = None) -> DataFrame:
    """Category of each report group: by group name, else by its account, else UNKNOWN.

    ``groups`` has group_name and account_id; ``projects`` carries row_idx for "first row wins".
    """
    require_columns(projects, ["row_idx", "CUST_ID", "BIG_GROUPING_CUST", "CATEGORY"], "project table")
    name = F.upper(clean(col("group_name")))
    out = attach(groups, projects, name, F.upper(clean(col("BIG_GROUPING_CUST"))), {"_by_name": "CATEGORY"},
                 order=["row_idx"])
    out = attach(out, projects, account_key(col("account_id")), account_key(col("CUST_ID")), {"_by_id": "CATEGORY"},
                 order=["row_idx"])
    out = out.withColumn("category", F.coalesce(F.nullif(F.col("_by_name"), F.lit("")),
                                                F.nullif(F.col("_by_id"), F.lit("")), F.lit("UNKNOWN")))
    out = out.drop("_by_name", "_by_id")
    if industries is None:
        return out
    require_columns(industries, ["row_idx", "BIG_GROUPING_CUST", "CUST_INDUSTRY_NEW"], "industry table")
    out = attach(out, industries.where(col("CUST_INDUSTRY_NEW").isNotNull()), name,
                 F.upper(clean(col("BIG_GROUPING_CUST"))), {"_industry": "CUST_INDUSTRY_NEW"}, order=["row_idx"])
    return out.withColumn("industry", F.coalesce(F.col("_industry"), F.lit("UNKNOWN"))).drop("_industry")


def group_accounts(projects: DataFrame) -> DataFrame:
    """Distinct accounts of every group with the row they first appear in.

    The list of ids stays a relation (order by first_idx): a report semi-joins it,
    so a group with very many accounts never becomes one array value.
    """
    rows = projects.select(
        F.nullif(F.upper(clean(col("BIG_GROUPING_CUST"))), F.lit("")).alias("group_name"),
        account_text(col("CUST_ID")).alias("account_id"),
        col("row_idx"),
    ).where("group_name is not null and account_id is not null")
    return rows.groupBy("group_name", "account_id").agg(F.min("row_idx").alias("first_idx"))


def accounts_by_name(projects: DataFrame, names: list[str], *, literal: bool = False) -> DataFrame:
    """Accounts whose customer name matches a report's group name (a regex unless ``literal``).

    The names come from the report configs, so the match is a narrow expression
    over the project table instead of a join of every name with every customer.
    """
    upper = F.upper(col("CUST_NAME"))
    hits = [F.when(upper.rlike(re.escape(n.upper()) if literal else n.upper()), F.lit(n)) for n in names]
    rows = projects.select(
        F.explode(F.array_compact(F.array(*hits))).alias("group_name"),
        account_text(col("CUST_ID")).alias("account_id"),
        col("row_idx"),
    ).where("account_id is not null")
    return rows.groupBy("group_name", "account_id").agg(F.min("row_idx").alias("first_idx"))


#: Longest grams of the name index; shorter literal runs are looked up as grams of their own length.
GRAM = 3
_CUT = "\u0000"


def required_runs(pattern: Column, literal: bool = False) -> Column:
    """Literal runs every match of a regex must contain, upper-cased.

    Escapes, character classes, characters made optional by ?, * or {0,} and all other
    metacharacters cut runs. A pattern with a group or an alternation gives none: every name
    is then a candidate, so nothing is missed.
    """
    upper = F.upper(pattern)
    if literal:
        return F.array(upper)
    p = F.regexp_replace(upper, r"\\.", _CUT)
    p = F.regexp_replace(p, r"\[[^\]]*\]", _CUT)
    p = F.regexp_replace(p, r".(?:[?*]|\{0(?:,\d*)?\})", _CUT)
    p = F.regexp_replace(p, r"\{\d+(?:,\d*)?\}", _CUT)
    runs = F.filter(F.split(p, r"[\x00.^$*+?()\[\]{}|\\]"), lambda r: F.length(r) > 0)
    return F.when(upper.rlike(r"[(|]"), F.array().cast("array<string>")).otherwise(runs)


def grams(text: Column, size: int) -> Column:
    """All substrings of `size` characters; the text itself where it is shorter."""
    n = F.length(text)
    return F.when(n <= size, F.array(text)).otherwise(
        F.transform(F.sequence(F.lit(1), n - size + 1), lambda i: F.substring(text, i, size)))


def name_index(names: DataFrame) -> DataFrame:
    """(gram, name): the inverted index of names by every substring of 1 to GRAM characters.

    Every name is listed under the empty gram too: the posting list of a pattern that needs no
    literal, which may match any name.
    """
    every = F.flatten(F.array(F.array(F.lit("")), *[F.when(F.length("name") >= k, grams(F.col("name"), k)).otherwise(F.array().cast("array<string>")) for k in range(1, GRAM + 1)]))
    return names.select(F.explode(F.array_distinct(every)).alias("gram"), "name")


def accounts_by_pattern(projects: DataFrame, patterns: DataFrame, *, literal: bool = False) -> DataFrame:
    """(group_name, account_id, first_idx) of customers whose upper-cased name matches a pattern.

    ``patterns`` has group_name, a regex (a plain text if ``literal``) matched against the
    upper-cased name anywhere in it, as ``accounts_by_name`` does. Names never leave Spark: each
    pattern is looked up in a gram index of the names by the rarest gram of its required literal
    runs, and the regex runs on those candidates only. A pattern without a literal run (a group,
    an alternation, only metacharacters) takes the list of every name, so nothing is missed.
    Null patterns and null names match nothing.
    """
    names = projects.select(F.upper(col("CUST_NAME")).alias("name")).where("name is not null").distinct()
    index = name_index(names)
    wanted = patterns.select("group_name").where("group_name is not null").distinct()
    runs = wanted.select("group_name", F.explode_outer(required_runs(F.col("group_name"), literal)).alias("run"))
    needed = runs.select("group_name", F.explode(F.when(F.col("run").isNull(), F.array(F.lit(""))).otherwise(grams(F.col("run"), GRAM))).alias("gram")).distinct()
    rarity = index.groupBy("gram").agg(F.count("*").alias("df"))
    rarest = needed.join(rarity.hint("merge"), "gram", "left").groupBy("group_name").agg(F.min_by("gram", F.coalesce("df", F.lit(0))).alias("gram"))
    # size estimates don't know that an index has many grams a name: unhinted, Spark may broadcast it
    candidates = rarest.join(index.hint("merge"), "gram").select("group_name", "name")
    hit = F.col("name").contains(F.upper("group_name")) if literal else F.expr("name rlike upper(group_name)")
    matched = candidates.where(hit)
    rows = projects.select(F.upper(col("CUST_NAME")).alias("name"), account_text(col("CUST_ID")).alias("account_id"), col("row_idx")).where("account_id is not null")
    return matched.join(rows.hint("merge"), "name").groupBy("group_name", "account_id").agg(F.min("row_idx").alias("first_idx"))


def without_group(names: DataFrame, by_group: DataFrame) -> DataFrame:
    """The names that are no group's. Account tables compress well, so their file size would have them broadcast."""
    return names.join(by_group.select("group_name").distinct().hint("merge"), "group_name", "left_anti")


def explicit_accounts(configs: DataFrame, by_group: DataFrame, by_name: DataFrame) -> DataFrame:
    """Accounts of each report: its own list, else those of its group, else those found by name.

    ``configs`` has group_name (upper case) and account_id, null where the report names none.
    """
    own = configs.where("account_id is not null").select("group_name", "account_id", F.lit("explicit").alias("source"))
    open_groups = configs.where("account_id is null").select("group_name").distinct()
    grouped = open_groups.join(by_group.hint("merge"), "group_name").select("group_name", "account_id", F.lit("group").alias("source"))
    named = without_group(open_groups, by_group).join(by_name.hint("merge"), "group_name").select("group_name", "account_id", F.lit("name").alias("source"))
    return own.unionByName(grouped).unionByName(named).distinct()
