import unicodedata

import pytest
from pyspark.sql import functions as F

from webcapture.functions.names import alias_variants, normalize_name, upper_case_key
from webcapture.operators.country import (
    alias_conflicts,
    alias_coverage,
    audit_aliases,
    build_alias_index,
    conflict_remainder,
    dictionary_aliases,
    dictionary_entries,
    resolve_country,
)
from webcapture.sources.readers import iso_aliases, load_aliases, load_dictionary

DICTIONARY = """{"kr": ["KR", "Korea, South", "대한민국", "韩国"], "CI": ["Côte d'Ivoire"], "GW": "Guinea-Bissau",
 "US": ["U.S.A.", "United States", 7, null], "SL": ["Strasse Land"]}"""


@pytest.fixture(scope="module")
def aliases(spark):
    df = spark.createDataFrame([(DICTIONARY,)], "value string")
    return dictionary_aliases(dictionary_entries(df))


def test_dictionary_file(spark, tmp_path, aliases):
    path = tmp_path / "aliases.json"
    path.write_text(DICTIONARY, encoding="utf-8")
    assert sorted(load_aliases(spark, str(path)).collect()) == sorted(aliases.collect())
    assert {r.code for r in aliases.collect()} == {"KR", "CI", "GW", "US", "SL"}
    assert load_dictionary(spark, str(path)).count() == 5


def test_normalize(column):
    values = ["  Côte  d'Ivoire! ", "Guinea-Bissau", "a_b__c", "ＡＢＣ　ｄ", "Straße", "ﬁn", "", None, "Ελλάδα", "한국"]
    got = column(values, normalize_name("c"))
    assert got[:9] == ["cote d'ivoire", "guinea-bissau", "a b c", "abc d", "straße", "fin", "", None, "ελλαδα"]
    assert got[9] == unicodedata.normalize("NFKD", "한국")
    assert column(got, normalize_name("c")) == got


def test_upper_case_key(column):
    """Null exactly where upper case changes nothing, for every letter and some words."""
    letters = [chr(i) for i in range(0x41, 0x10000) if chr(i).isalpha()]
    words = letters + ["Straße", "ŉab", "ελλασ", "Ελλάς", "ΣΑΣ", "ﬁne", "İzmir", "ısı", "plain", "", None]
    plain = column(words, normalize_name("c"))
    upper = column(words, normalize_name(F.upper("c")))
    keys = column(words, upper_case_key("c"))
    assert [k if k is not None else p for k, p in zip(keys, plain)] == upper
    assert sum(k is not None for k in keys) < 200


def test_variants(column):
    got = column(["Korea, South", "U.S.A.", "Viet Nam", " , ", None], alias_variants("c"))
    assert got[0] == ["Korea, South", "korea south", "South Korea", "south korea"]
    assert got[1] == ["U.S.A.", "u s a"]
    assert got[2] == ["Viet Nam", "viet nam", "nam viet"]
    assert got[3] == [","]


@pytest.mark.parametrize(
    "name,code,rule",
    [
        ("South Korea", "KR", "alias"),
        ("韩国", "KR", "alias"),
        ("kr", "KR", "alias"),
        ("COTE D'IVOIRE", "CI", "alias"),
        ("bissau guinea", "US", "default"),
        ("guinea-bissau", "GW", "alias"),
        ("zz", "ZZ", "two_letter"),
        (" Zé ", "ZÉ", "two_letter"),
        ("中文", "中文", "two_letter"),
        ("Straße Land", "SL", "alias_upper"),
        ("u.s.a", "US", "alias"),
        ("z1", "US", "default"),
        ("Atlantis", "US", "default"),
        ("\u3000", "US", "blank"),
        (None, "US", "blank"),
    ],
)
def test_resolve(spark, aliases, name, code, rule):
    df = spark.createDataFrame([(name,)], "name string")
    row = resolve_country(df, "name", build_alias_index(aliases)).first()
    assert (row.country_code, row.match_rule) == (code, rule)


@pytest.mark.parametrize("salts", [1, 16])
def test_resolve_skewed_names_without_broadcast(spark, aliases, salts):
    """One name holds most rows and the index is not broadcast: nothing is lost, and with salts no task
    gets most of the rows."""
    rows = spark.range(30000).select(
        "id",
        F.when(F.col("id") % 3 > 0, "South Korea").when(F.col("id") % 2 == 0, F.concat(F.lit("x"), F.col("id"))).alias("name"),
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        resolved = resolve_country(rows, "name", build_alias_index(aliases), salts=salts)
        got = resolved.groupBy("country_code", "match_rule").count().collect()
        per_task = [r["count"] for r in resolved.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {(r.country_code, r.match_rule): r["count"] for r in got} == {
        ("KR", "alias"): 20000, ("US", "default"): 5000, ("US", "blank"): 5000,
    }
    assert max(per_task) < 15000


def test_iso_seed_covers_itself(spark):
    aliases = iso_aliases(spark)
    assert aliases.select("code").distinct().count() == 249
    assert alias_coverage(aliases, build_alias_index(aliases)).count() == 0


def test_audit(spark):
    bad = '{"AA": ["Foo", "Foo", "Foo", 5], "BB": ["foo."], "CC": "solo"}'
    entries = dictionary_entries(spark.createDataFrame([(bad,)], "value string"))
    required = spark.createDataFrame([("AA",), ("DD",)], "code string")
    row = audit_aliases(entries, required).first().asDict()
    assert row == {
        "n_codes": 3, "n_aliases": 5, "n_type_issues": 2, "n_duplicates": 2, "n_missing": 1, "n_conflicts": 1, "passed": False,
    }
    good = dictionary_entries(spark.createDataFrame([('{"AA": ["Foo"]}',)], "value string"))
    assert audit_aliases(good, required.filter("code = 'AA'")).first().passed


def test_conflict_report_limit(spark):
    names = [(f"n{i}", code) for i in range(60) for code in ("BB", "AA")]
    aliases = spark.createDataFrame(names, "alias string, code string")
    assert alias_conflicts(aliases).count() == 60
    shown = alias_conflicts(aliases, limit=50).collect()
    assert len(shown) == 50 and shown[0].key == "n0" and shown[0].codes == ["AA", "BB"]
    assert conflict_remainder(aliases).first().more == 10
    assert alias_conflicts(aliases, limit=None).count() == 60
