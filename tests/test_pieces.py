"""What a Python worker holds is bounded by its batch and one piece, whatever comes out of the batch."""

import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from webcapture.functions import batches, html_events, names
from webcapture.operators.pages import clean_pages


def test_pieces_are_all_texts_in_order():
    texts = ["a" * 30, None, "", "é" * 40, "b" * 500, "c", None]
    found = list(batches.pieces(iter([pa.array(texts), pa.array([], pa.string()), pa.array(["d"])]), 100))
    assert [x for piece in found for x in piece.to_pylist()] == [*texts, "d"] and len(found) > 3
    assert all(sum(len((x or "").encode()) for x in piece.to_pylist()[1:]) < 100 for piece in found)


def test_events_go_back_piece_by_piece():
    page = '<p class="x">some <b>bold</b> text &amp; more</p>' * 2000
    batch = pa.array([page, None, ""] * 40)
    found = list(html_events.scan_pieces(iter([batch]), (), (), with_raw=True))
    assert len(found) >= 3 and max(len(piece) for piece in found) < len(batch) / 2
    assert pa.concat_arrays(found).equals(html_events.scan_batch(batch, (), (), with_raw=True))


def test_names_go_back_piece_by_piece():
    texts = ["Ünïcode ﬁ " * 20_000, None, "", "plain"] * 12
    found = list(names._nfkd.func(iter([pa.array(texts)])))
    assert len(found) > 2
    assert [x for piece in found for x in piece.to_pylist()] == [x and unicodedata.normalize("NFKD", x) for x in texts]


def test_several_names_and_pages_in_one_query(spark):
    """Results of several pieces meet the rows that they were made from."""
    df = spark.range(0, 900, numPartitions=2).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("<p>É "), F.col("id"), F.repeat(F.lit(" é"), 3000), F.lit("</p><style>x</style>"))).alias("html"),
    )
    rows = clean_pages(df).select("page_id", "clean_html", names.normalize_name("clean_html").alias("a"), names.normalize_name(F.reverse("clean_html")).alias("b")).collect()
    assert len(rows) == 900
    for r in rows:
        if r.page_id % 7 == 0:
            assert r.clean_html in (None, "") and r.a in (None, "") and r.b in (None, "")
        else:
            assert r.clean_html == f"<p>É {r.page_id}" + " é" * 3000 + "</p>"
            assert r.a == f"p e {r.page_id}" + " e" * 3000 + " p" and r.b == "p " + "e " * 3000 + f"{str(r.page_id)[::-1]} e p"
