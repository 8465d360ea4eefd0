"""Queries for country resolution and the alias audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.common import registry, table
from checks.responses import _DICT
from webcapture.operators.country import (
    alias_conflicts,
    alias_coverage,
    alias_type_issues,
    audit_aliases,
    build_alias_index,
    conflict_remainder,
    dictionary_entries,
    duplicate_aliases,
    missing_codes,
    resolve_country,
)

QUERIES, ORACLES, query = registry()

# Code, alias in the dictionary, another spelling that must resolve to it.
_COUNTRIES = (
    ("FR", "France", "FRANCE"),
    ("KR", "Korea, South", "south korea"),
    ("CI", "Côte d''Ivoire", "Cote d''Ivoire"),
    ("ST", "São Tomé & Príncipe", "Sao Tome  Principe"),
    ("AX", "Åland Islands", "islands aland"),
    ("CW", "Curaçao", "CURAÇAO."),
    ("CN", "中国", " 中国　"),
    ("TL", "Timor-Leste", "timor-leste"),
    ("US", "U.S.A.", "u s a"),
    ("VN", "Viet Nam", "viet_nam"),
)


def _by_nation(column: str, which: int) -> str:
    cases = " ".join(f"WHEN {i} THEN '{c[which]}'" for i, c in enumerate(_COUNTRIES))
    return f"CASE CAST({column} % {len(_COUNTRIES)} AS INT) {cases} END"


_NAME = f"""CASE CAST(c_custkey % 8 AS INT) WHEN 0 THEN {_by_nation('c_nationkey', 1)} WHEN 1 THEN {_by_nation('c_nationkey', 2)}
    WHEN 2 THEN concat('  ', upper({_by_nation('c_nationkey', 1)}), ' ') WHEN 3 THEN NULL WHEN 4 THEN ' zq ' WHEN 5 THEN concat('Nowhere ', c_custkey)
    WHEN 6 THEN 'Straße Land' ELSE ' ' END"""


def _aliases(spark, sf):
    """Aliases per nation, and one for the upper-case rule."""
    nations = table(spark, sf, "nation")
    own = nations.select(F.expr(_by_nation("n_nationkey", 0)).alias("code"), F.expr(_by_nation("n_nationkey", 1)).alias("alias"))
    return own.unionByName(nations.select(F.lit("ZL").alias("code"), F.lit("Strasse Land").alias("alias")))


@query(
    "resolve_country",
    f"""SELECT c_custkey, CASE CAST(c_custkey % 8 AS INT) WHEN 3 THEN 'US' WHEN 4 THEN 'ZQ' WHEN 5 THEN 'US' WHEN 6 THEN 'ZL' WHEN 7 THEN 'US'
        ELSE {_by_nation('c_nationkey', 0)} END AS country_code, CASE CAST(c_custkey % 8 AS INT) WHEN 3 THEN 'blank' WHEN 4 THEN 'two_letter' WHEN 5 THEN 'default'
        WHEN 6 THEN 'alias_upper' WHEN 7 THEN 'blank' ELSE 'alias' END AS match_rule FROM customer""",
)
def _(spark, sf):
    names = table(spark, sf, "customer").select("c_custkey", F.expr(_NAME).alias("name"))
    resolved = resolve_country(names, "name", build_alias_index(_aliases(spark, sf)))
    return resolved.select("c_custkey", "country_code", "match_rule")


_PART = "concat(p_name, CASE WHEN p_partkey % 3 = 0 THEN concat(', ', p_type) ELSE '!' END)"
_NORM = "trim(regexp_replace(regexp_replace(lower({}), '[^a-z0-9''_ -]', ' ', 'g'), '[_ ]+', ' ', 'g'))"
_KEYS = f"""
    SELECT code, {_NORM.format('v')} AS key FROM (SELECT code, unnest(all_v) AS v FROM (
        SELECT code, [base, trim(regexp_replace(norm, '[^a-z0-9 ]', '', 'g')),
            CASE WHEN len(parts) >= 2 THEN array_to_string(list_reverse(parts), ' ') END,
            CASE WHEN len(string_split(norm, ' ')) = 2 THEN array_to_string(list_reverse(string_split(norm, ' ')), ' ') END] AS all_v
        FROM (SELECT code, trim(alias) AS base, {_NORM.format('alias')} AS norm,
              list_filter(list_transform(string_split(trim(alias), ','), lambda p: trim(p)), lambda p: p <> '') AS parts FROM ({{aliases}}))))
    WHERE v IS NOT NULL AND {_NORM.format('v')} <> ''"""
_PART_ALIASES = f"SELECT p_brand AS code, {_PART} AS alias FROM part"


def _part_aliases(spark, sf):
    return table(spark, sf, "part").select(F.col("p_brand").alias("code"), F.expr(_PART).alias("alias"))


@query("alias_index", f"SELECT key, min(code) AS code FROM ({_KEYS.format(aliases=_PART_ALIASES)}) GROUP BY key")
def _(spark, sf):
    return build_alias_index(_part_aliases(spark, sf))


@query(
    "alias_coverage",
    f"""SELECT a.code AS expected, a.alias AS name, i.code AS country_code FROM ({_PART_ALIASES}) a
        JOIN (SELECT key, min(code) AS code FROM ({_KEYS.format(aliases=_PART_ALIASES)}) GROUP BY key) i ON i.key = {_NORM.format('a.alias')}
        WHERE i.code <> a.code""",
)
def _(spark, sf):
    aliases = _part_aliases(spark, sf)
    return alias_coverage(aliases, build_alias_index(aliases))


@query(
    "missing_codes",
    """SELECT DISTINCT concat('N', s_nationkey) AS code FROM supplier WHERE s_nationkey NOT IN (SELECT c_nationkey FROM customer WHERE c_nationkey % 3 <> 0)""",
)
def _(spark, sf):
    have = table(spark, sf, "customer").selectExpr("concat(CASE WHEN c_nationkey % 3 = 0 THEN 'M' ELSE 'N' END, c_nationkey) AS code")
    required = table(spark, sf, "supplier").select(F.expr("concat('N', s_nationkey)").alias("code"))
    return missing_codes(have, required)


@query(
    "duplicate_aliases",
    "SELECT concat('N', c_nationkey) AS code, c_mktsegment AS alias, count(*) - 1 AS repeats FROM customer GROUP BY 1, 2 HAVING count(*) > 1",
)
def _(spark, sf):
    aliases = table(spark, sf, "customer").select(F.expr("concat('N', c_nationkey)").alias("code"), F.col("c_mktsegment").alias("alias"))
    return duplicate_aliases(aliases)


def _entries(spark, sf):
    return dictionary_entries(table(spark, sf, "customer").select(F.expr(_DICT).alias("value")))


_ISSUES = """
    SELECT concat('n', c_nationkey) AS code, 'alias list is not a list' AS issue, concat('"', c_name, '"') AS value FROM customer WHERE c_custkey % 4 = 0
    UNION ALL SELECT concat('n', c_nationkey), 'alias list is not a list', concat('{"a":"', c_name, '"}') FROM customer WHERE c_custkey % 4 = 2
    UNION ALL SELECT concat('n', c_nationkey), 'non-string alias', '5' FROM customer WHERE c_custkey % 4 = 1
    UNION ALL SELECT concat('n', c_nationkey), 'non-string alias', 'null' FROM customer WHERE c_custkey % 4 = 1"""


@query("alias_type_issues", _ISSUES)
def _(spark, sf):
    return alias_type_issues(_entries(spark, sf))


_SHARED = "SELECT concat('N', c_nationkey) AS code, concat(c_mktsegment, ' ', c_custkey % 40, '.') AS alias FROM customer"
_CONFLICTS = f"SELECT key, list_sort(list(DISTINCT code)) AS codes FROM ({_KEYS.format(aliases=_SHARED)}) GROUP BY key HAVING count(DISTINCT code) > 1"


def _shared_aliases(spark, sf):
    return table(spark, sf, "customer").selectExpr("concat('N', c_nationkey) AS code", "concat(c_mktsegment, ' ', c_custkey % 40, '.') AS alias")


@query("alias_conflicts", f"SELECT key, array_to_string(codes, ',') AS codes FROM ({_CONFLICTS}) ORDER BY key LIMIT 50")
def _(spark, sf):
    return alias_conflicts(_shared_aliases(spark, sf), limit=50).withColumn("codes", F.array_join("codes", ","))


@query("alias_conflicts_all", f"SELECT key, array_to_string(codes, ',') AS codes FROM ({_CONFLICTS})")
def _(spark, sf):
    return alias_conflicts(_shared_aliases(spark, sf)).withColumn("codes", F.array_join("codes", ","))


@query("conflict_remainder", f"SELECT greatest(count(*) - 50, 0) AS more FROM ({_CONFLICTS})")
def _(spark, sf):
    return conflict_remainder(_shared_aliases(spark, sf))


_LISTED = """SELECT concat('n', c_nationkey) AS code, c_name AS alias FROM customer WHERE c_custkey % 4 = 1
    UNION ALL SELECT concat('n', c_nationkey), c_mktsegment FROM customer WHERE c_custkey % 4 = 1
    UNION ALL SELECT 'x', c_name FROM customer WHERE c_custkey % 4 = 1"""


@query(
    "audit_aliases",
    f"""WITH d AS (SELECT CAST(count(DISTINCT code) AS BIGINT) AS n_codes FROM (SELECT concat('n', c_nationkey) AS code FROM customer WHERE c_custkey % 4 < 3 UNION ALL SELECT 'x' FROM customer WHERE c_custkey % 4 = 1)),
        a AS (SELECT count(*) * 5 AS n_aliases FROM customer WHERE c_custkey % 4 = 1),
        t AS (SELECT count(*) AS n_type_issues FROM ({_ISSUES})),
        u AS (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM ({_LISTED}) GROUP BY code, alias)),
        m AS (SELECT count(DISTINCT n_nationkey) AS n_missing FROM nation WHERE n_nationkey + 20 NOT IN (SELECT c_nationkey FROM customer WHERE c_custkey % 4 < 3)),
        c AS (SELECT count(*) AS n_conflicts FROM (SELECT key FROM ({_KEYS.format(aliases=_LISTED)}) GROUP BY key HAVING count(DISTINCT code) > 1))
        SELECT *, n_type_issues + n_duplicates + n_missing + n_conflicts = 0 AS passed FROM d, a, t, u, m, c""",
)
def _(spark, sf):
    required = table(spark, sf, "nation").selectExpr("concat('n', n_nationkey + 20) AS code")
    return audit_aliases(_entries(spark, sf), required)
