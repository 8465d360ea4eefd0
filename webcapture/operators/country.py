"""Country resolution and the audit of its alias dictionary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from webcapture.functions.names import alias_variants, nfkd, normalize_name, upper_case_key
from webcapture.functions.text import strip
from webcapture.functions.variant import parse_body


def dictionary_entries(df: DataFrame, json_col: str = "value") -> DataFrame:
    """``(code, names)`` per member of JSON dictionaries; ``names`` stays VARIANT, code as written."""
    members = F.try_variant_get(parse_body(json_col), "$", "map<string,variant>")
    return df.select(F.explode(members).alias("code", "names"))


def dictionary_aliases(entries: DataFrame, as_written: bool = False) -> DataFrame:
    """``(code, alias)``; a single string counts as a list, non-strings are skipped.

    Codes become upper-case, unless the audit asks for them as they are written.
    """
    names = F.coalesce(F.try_variant_get("names", "$", "array<variant>"), F.array("names"))
    code = F.col("code") if as_written else F.upper("code")
    each = entries.select(code.alias("code"), F.explode(names).alias("name"))
    return each.filter(F.schema_of_variant("name") == "STRING").select(
        "code", F.try_variant_get("name", "$", "string").alias("alias")
    )


def _alias_keys(aliases: DataFrame) -> DataFrame:
    variants = aliases.select("code", F.explode(alias_variants("alias")).alias("variant"))
    # A filter on the key would be moved below it, with a second call of the Python function.
    keys = F.filter(F.array(normalize_name("variant")), lambda k: k != "")
    return variants.select("code", F.explode(keys).alias("key"))


def build_alias_index(aliases: DataFrame) -> DataFrame:
    """``key -> code``; a key claimed by several codes goes to the smallest (see ``alias_conflicts``)."""
    return _alias_keys(aliases).groupBy("key").agg(F.min("code").alias("code"))


#: Names that the sketch reports and follows; parts that a name with all rows would be split into.
REPORTED, FOLLOWED, PARTS = 200, 10_000, 1024


def fits_broadcast(df: DataFrame) -> bool:
    """Whether Spark's own estimate lets it broadcast the table, so that no row of the other side moves."""
    limit = int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())
    return df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= limit


def heavy_names(df: DataFrame, col: str) -> DataFrame:
    """``key, _parts`` of normalised names that hold a thousandth of the rows or more, by one sketch over the column.

    At most two keys for each of the ``REPORTED`` names, whatever the table; ``_parts`` grows with the share.
    """
    top = F.call_function("approx_top_k", F.col(col), F.lit(REPORTED), F.lit(FOLLOWED))
    counted = df.agg(top.alias("top"), F.count("*").alias("total"))
    names = counted.select("total", F.explode("top").alias("x")).select(strip("x.item").alias("name"), (F.col("x.count") / F.col("total")).alias("share"))
    keys = names.filter(f"share >= {1 / PARTS}").select("share", F.explode(F.array_distinct(F.array(normalize_name("name"), upper_case_key("name")))).alias("key"))
    shares = keys.filter("key != ''").groupBy("key").agg(F.sum("share").alias("share"))
    return shares.select("key", F.least(F.ceil(F.col("share") * PARTS), F.lit(PARTS)).cast("int").alias("_parts"))


def resolve_country(
    df: DataFrame, col: str, alias_index: DataFrame, default: str = "US", salts: int | None = None
) -> DataFrame:
    """Add ``country_code`` and ``match_rule``.

    Blank names take the default; then an index hit on the normalised name; then two letters are
    taken as a code, unchecked; then a hit on the normalised upper-case name; else the default.

    No broadcast is forced: Spark broadcasts the index while its size allows that, and no row moves.
    Beyond, rows are shuffled by name. A sketch over the names then reports the frequent ones, and only
    these are split, each into parts in proportion to its share, against as many copies of its index rows.
    ``salts`` splits all names into so many parts instead; a stream, which cannot be counted before, splits
    none without it. Rows are told apart by their place in the input, so equal rows are split like any
    others, and rows without a key to look up are spread.
    """
    name = strip(col)
    # The place only balances: which part a row joins in does not change what it finds.
    keyed = df.withColumn("_row", F.monotonically_increasing_id()).withColumn("_name", name)
    keyed = keyed.withColumn("_key", normalize_name("_name")).withColumn("_upper", upper_case_key("_name"))
    # A normalised name holds no "#", so these keys match nothing.
    nowhere = F.concat(F.lit("#"), F.pmod("_row", F.lit(4096)).cast("string"))
    keyed = keyed.select(
        "*",
        F.when(F.col("_key") != "", F.col("_key")).otherwise(nowhere).alias("_first"),
        F.when(F.col("_upper") != F.col("_key"), F.col("_upper")).otherwise(nowhere).alias("_second"),
    )
    heavy = None if salts or df.isStreaming or fits_broadcast(alias_index) else heavy_names(df, col)

    def looked_up(rows, key, code):
        index, parts = alias_index.select(F.col("key").alias(key), F.col("code").alias(code)), F.lit(salts or 1)
        if heavy is not None:
            # Bounded by what the sketch reports.
            own = F.broadcast(heavy.withColumnRenamed("key", key))
            rows, index, parts = rows.join(own, key, "left"), index.join(own, key, "left"), F.coalesce("_parts", F.lit(1))
        copies = F.explode(F.sequence(F.lit(0), parts - 1)) if heavy is not None or (salts or 1) > 1 else F.lit(0)
        rows = rows.withColumn("_salt", F.pmod("_row", parts).cast("int")).drop("_parts")
        return rows.join(index.withColumn("_salt", copies).drop("_parts"), [key, "_salt"], "left").drop("_salt")

    joined = looked_up(looked_up(keyed, "_first", "_code"), "_second", "_upper_code")
    blank = F.coalesce(F.col("_name"), F.lit("")) == ""
    two = F.coalesce(F.col("_name").rlike(r"\A\p{L}{2}\z"), F.lit(False))
    code, upper_code = F.col("_code"), F.col("_upper_code")
    rule = (
        F.when(blank, "blank")
        .when(code.isNotNull(), "alias")
        .when(two, "two_letter")
        .when(upper_code.isNotNull(), "alias_upper")
        .otherwise("default")
    )
    resolved = (
        F.when(blank, F.lit(default))
        .when(code.isNotNull(), code)
        .when(two, F.upper("_name"))
        .otherwise(F.coalesce(upper_code, F.lit(default)))
    )
    return joined.select(*df.columns, resolved.alias("country_code"), rule.alias("match_rule"))


def missing_codes(aliases: DataFrame, required: DataFrame) -> DataFrame:
    """Required codes that the dictionary lacks."""
    # Distinct on both sides, so that a code with many aliases reaches the join once per task.
    have = aliases.select("code").distinct()
    return required.select("code").distinct().join(have, "code", "left_anti")


def duplicate_aliases(aliases: DataFrame) -> DataFrame:
    """Aliases repeated inside one code, with the number of repeats."""
    counted = aliases.groupBy("code", "alias").agg((F.count("*") - 1).alias("repeats"))
    return counted.filter("repeats > 0")


def alias_type_issues(entries: DataFrame) -> DataFrame:
    """``(code, issue, value)`` for lists that are none and aliases that are no strings."""
    listed = F.try_variant_get("names", "$", "array<variant>")
    not_list = F.array(
        F.struct(F.lit("alias list is not a list").alias("issue"), F.to_json("names").alias("value"))
    )
    not_string = F.transform(
        F.filter(listed, lambda x: F.schema_of_variant(x) != "STRING"),
        lambda x: F.struct(F.lit("non-string alias").alias("issue"), F.to_json(x).alias("value")),
    )
    issues = F.when(listed.isNull(), not_list).otherwise(not_string)
    return entries.select("code", F.explode(issues).alias("i")).select("code", "i.issue", "i.value")


def alias_conflicts(aliases: DataFrame, limit: int | None = None) -> DataFrame:
    """Normalised keys that lead to several codes, with the sorted codes, in order of the key.

    The list of a key is bounded by the number of country codes. A report may ask for a limit; see
    ``conflict_remainder`` for what it leaves out.
    """
    # Distinct pairs first, so that a key repeated all over the table arrives once per code.
    pairs = _alias_keys(aliases).distinct()
    grouped = pairs.groupBy("key").agg(F.sort_array(F.collect_list("code")).alias("codes"))
    conflicts = grouped.filter(F.size("codes") > 1).orderBy("key")
    return conflicts if limit is None else conflicts.limit(limit)


def _conflicting_keys(aliases: DataFrame) -> DataFrame:
    spread = _alias_keys(aliases).groupBy("key").agg(F.min("code").alias("lo"), F.max("code").alias("hi"))
    return spread.filter("lo <> hi").select("key")


def conflict_remainder(aliases: DataFrame, limit: int = 50) -> DataFrame:
    """One row: how many conflicting keys a report of ``limit`` keys leaves out."""
    return _conflicting_keys(aliases).agg(F.greatest(F.count("*") - limit, F.lit(0)).alias("more"))


def audit_aliases(entries: DataFrame, required: DataFrame) -> DataFrame:
    """One row: counts of codes and aliases, issues by kind, and whether the dictionary passes.

    Each input is read once: every entry gives rows ``(measure, k1, k2, n)``, and two grouped sums tell what
    repeats, what is missing and which keys lead to several codes.
    """
    as_list = F.try_variant_get("names", "$", "array<variant>")
    strings = F.transform(
        F.filter(as_list, lambda x: F.schema_of_variant(x) == "STRING"), lambda x: F.try_variant_get(x, "$", "string")
    )
    bad = F.when(as_list.isNull(), F.lit(1)).otherwise(F.size(as_list) - F.size(strings))
    listed = F.coalesce(F.size(as_list), F.lit(0))
    each = entries.select("code", listed.alias("listed"), bad.alias("bad"), F.posexplode_outer(strings).alias("pos", "alias"))

    def measure(name, k1, k2, n):
        parts = zip((F.lit(name), k1, k2, n.cast("long")), ("measure", "k1", "k2", "n"))
        return F.struct(*[c.alias(field) for c, field in parts])

    none, zero, code = F.lit(""), F.lit(0), F.col("code")
    of_entry = F.array(
        measure("code", code, F.lit("have"), zero),
        measure("aliases", none, none, F.col("listed")),
        measure("types", none, none, F.col("bad")),
    )
    of_alias = F.concat(
        F.array(measure("alias", code, F.col("alias"), zero)),
        F.transform(alias_variants("alias"), lambda v: measure("key", v, code, zero)),
    )
    first, given = F.coalesce(F.col("pos") == 0, F.lit(True)), F.col("alias").isNotNull()
    empty = F.slice(of_entry, 1, 0)
    rows = each.select(F.explode(F.concat(F.when(first, of_entry).otherwise(empty), F.when(given, of_alias).otherwise(empty))).alias("r"))
    is_key = F.col("r.measure") == "key"
    key = F.when(is_key, normalize_name(F.when(is_key, F.col("r.k1")))).otherwise(F.col("r.k1"))
    rows = rows.select("r.measure", key.alias("k1"), "r.k2", "r.n")
    rows = rows.unionByName(required.select(F.lit("code").alias("measure"), code.alias("k1"), F.lit("need").alias("k2"), F.lit(0).cast("long").alias("n")))
    counted = rows.groupBy("measure", "k1", "k2").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    grouped = counted.groupBy("measure", "k1").agg(
        F.count("*").alias("kinds"),
        F.sum(F.col("c") - 1).alias("repeats"),
        F.sum("n").alias("n"),
        F.max(F.col("k2") == "have").alias("have"),
    )

    def total(name, amount):
        return F.coalesce(F.sum(F.when(F.col("measure") == name, amount)), F.lit(0)).cast("long")

    codes_of_key = F.when((F.col("k1") != "") & (F.col("kinds") > 1), 1).otherwise(0)
    summary = grouped.agg(
        total("code", F.col("have").cast("int")).alias("n_codes"),
        total("aliases", F.col("n")).alias("n_aliases"),
        total("types", F.col("n")).alias("n_type_issues"),
        total("alias", F.col("repeats")).alias("n_duplicates"),
        total("code", (~F.col("have")).cast("int")).alias("n_missing"),
        total("key", codes_of_key).alias("n_conflicts"),
    )
    issues = sum((F.col(n) for n in ("n_type_issues", "n_duplicates", "n_missing", "n_conflicts")), F.lit(0))
    return summary.withColumn("passed", issues == 0)


def fold_accents(c) -> Column:
    """Alias without its accents, letters otherwise as they are."""
    return F.regexp_replace(nfkd(c), r"\p{Mn}", "")


def alias_coverage(aliases: DataFrame, index: DataFrame) -> DataFrame:
    """Aliases that do not resolve to their own code, as written or without accents."""
    spellings = aliases.select(
        F.col("code").alias("expected"),
        F.explode(F.array_distinct(F.array("alias", fold_accents("alias")))).alias("name"),
    )
    resolved = resolve_country(spellings, "name", index)
    return resolved.filter(F.col("country_code") != F.col("expected")).select("expected", "name", "country_code")
