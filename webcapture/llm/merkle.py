"""A Merkle tree over the rows of a table, a subtree per source, and an inclusion proof for each row.

Slot pivot: at each level conditional aggregates spread the children of a parent into one column per slot. All
slot columns in a row, hashed, are the parent; all but a child's own are its siblings. Going up, every level is
a sixteenth of the one below; going down, each parent's row hands its own path to its children, so proofs exist
only within the task that digests them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from webcapture.llm.common import saved
from webcapture.llm.ranks import numbered

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left: string, right: string>>"


def _hashed(*texts: Column) -> Column:
    return F.sha2(F.concat(*texts), 256)


def framed(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _pivot(nodes: DataFrame, fanout: int) -> DataFrame:
    """A row per parent: its children in the columns ``s0`` to ``s15``, the missing ones null."""
    slots = [F.max(F.when(F.col("idx") % fanout == k, F.col("own"))).alias(f"s{k}") for k in range(fanout)]
    return nodes.filter("width > 1").groupBy("key", F.expr(f"idx div {fanout}").alias("parent"), "width").agg(*slots)


def _climb(nodes: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The pivots of all levels, lowest first, and the top of each tree: ``key, level, digest``."""
    top = nodes.agg(F.max("width")).first()[0] or 0
    pivots, level = [], 0
    tops = [nodes.filter("width = 1").select("key", F.lit(0).alias("level"), "own.digest")]
    while top > 1:
        pivots.append(saved(_pivot(nodes, fanout), "pivot"))
        digest = _hashed(*(F.coalesce(f"s{k}.digest", F.lit("")) for k in range(fanout)))
        width = F.expr(f"(width + {fanout - 1}) div {fanout}")
        nodes = pivots[-1].select("key", F.col("parent").alias("idx"), width.alias("width"), F.struct(digest.alias("digest")).alias("own"))
        top, level = -(-top // fanout), level + 1
        tops.append(nodes.filter("width = 1").select("key", F.lit(level).alias("level"), "own.digest"))
    return pivots, saved(reduce(DataFrame.union, tops), "tops")


def _children(pivot: DataFrame, above: DataFrame, fanout: int) -> DataFrame:
    """Each child with its own siblings in front of its parent's path."""
    side = lambda ks: F.concat(F.lit(""), *(F.coalesce(f"s{k}.digest", F.lit("")) for k in ks))
    slot = lambda k: F.struct(F.lit(k).alias("k"), F.col(f"s{k}").alias("own"), side(range(k)).alias("left"), side(range(k + 1, fanout)).alias("right"))
    met = pivot.join(above.withColumnRenamed("idx", "parent"), ["key", "parent"])
    apart = met.select("key", "parent", "path", "carried", F.explode(F.array(*map(slot, range(fanout)))).alias("slot")).filter("slot.own is not null")
    path = F.concat(F.array(F.struct("slot.left", "slot.right")), "path").cast(_PATH)
    return apart.select("key", (F.col("parent") * fanout + F.col("slot.k")).alias("idx"), path.alias("path"), "carried", "slot.own")


def _descend(pivots: list[DataFrame], tops: DataFrame, lone: DataFrame, fanout: int) -> DataFrame:
    """``key, path, carried, own`` of every leaf; ``tops`` has the path above each tree, ``lone`` the leaves that are trees."""
    at = lambda level: tops.filter(F.col("level") == level).select("key", F.lit(0).cast("long").alias("idx"), "path", "carried")
    above = at(len(pivots))
    for level in range(len(pivots) - 1, -1, -1):
        below = _children(pivots[level], above, fanout)
        above = below.select("key", "idx", "path", "carried").union(at(level)) if level else below.select("key", "path", "carried", "own")
    alone = at(0).join(lone.select("key", "own"), "key").select("key", "path", "carried", "own")
    return above.union(alone) if pivots else alone


def manifest(docs: DataFrame, tampered: Column | None = None, changed: Column | None = None, columns: tuple[str, ...] = COLUMNS, id_col: str = "doc_id", source_col: str = "source", fanout: int = 16) -> DataFrame:
    """A row per row of ``docs``: its id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    A leaf is the hash of the framed ``columns``. Leaves of a source ascend by id, null first, then by hash; every
    ``fanout`` of them become their hash, and so on until one node remains, the subroot; a lone leaf is its own.
    Subroots in the order of their sources, null first, then bytewise, give the root alike. ``folded_root`` is
    computed from the row as it is found later and the stored siblings: where ``tampered`` holds, the last of the
    ``columns`` is then ``changed``. ``verified`` says whether it is the root.

    Rows that are alike in all ``columns`` are one leaf each, side by side; nulls in any column are allowed, other
    columns ignored; an empty table gives no row. Texts are hashed where they are read; only digests move.
    """
    fields = {name: framed(F.col(name)) for name in columns}
    leaf = _hashed(*fields.values())
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    found = _hashed(*list(fields.values())[:-1], framed(changed)) if changed is not None else leaf
    key = F.coalesce(F.concat(F.lit("s"), F.col(source_col).cast("string")), F.lit(""))
    rows = docs.select(key.alias("key"), F.col(id_col).cast("long").alias("id"), leaf.alias("digest"), F.when(tampered, found).alias("found"))
    rows = rows.groupBy("key", "id", "digest", "found").agg(F.count("*").alias("copies"))
    placed = numbered(rows, ["key"], ["id", "digest", "found"], "copies")
    each = placed.select("key", "width", F.struct("digest", "id", "found").alias("own"), F.explode(F.sequence("idx", F.expr("idx + copies - 1"))).alias("idx"))
    leaves = saved(each, "leaves")
    pivots, subroots = _climb(leaves, fanout)

    sources = numbered(subroots, [], ["key"]).select(F.lit("").alias("key"), "idx", "width", F.struct("digest", F.col("key").alias("source_key"), "level").alias("own"))
    sources = saved(sources, "sources")
    upper, root = _climb(sources, fanout)
    above = root.select("key", "level", F.array().cast(_PATH).alias("path"), F.struct(F.lit("").alias("subroot"), F.col("digest").alias("root")).alias("carried"))
    tops = _descend(upper, above, sources.filter("width = 1"), fanout)
    carried = F.struct(F.col("own.digest").alias("subroot"), F.col("carried.root").alias("root"))
    tops = saved(tops.select(F.col("own.source_key").alias("key"), "own.level", "path", carried.alias("carried")), "tops")

    proofs = _descend(pivots, tops, leaves.filter("width = 1"), fanout)
    siblings = F.array_join(F.transform("path", lambda x: F.concat(x["left"], x["right"])), "")
    folded = F.aggregate("path", F.coalesce("own.found", "own.digest"), lambda h, x: F.sha2(F.concat(x["left"], h, x["right"]), 256))
    proofs = proofs.select(F.col("own.id").alias(id_col), F.col("own.digest").alias("leaf"), "carried.subroot", "carried.root", F.sha2(siblings, 256).alias("proof_sha256"), folded.alias("folded_root"))
    return proofs.withColumn("verified", F.col("folded_root") == F.col("root"))
