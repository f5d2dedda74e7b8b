"""SimHash near-duplicates, found by covering locality-sensitive hashing.

Every pair of fingerprints within ``radius`` bits shares a bucket in one of ``2^(radius+1) - 1``
tables: bit ``i`` has a nonzero vector ``m(i)`` of ``radius + 1`` bits, and the table of the
nonzero vector ``v`` keeps the bits with ``<m(i), v> = 1``. The vectors of at most ``radius``
differing bits leave some ``v`` orthogonal to all of them, and that table masks them all.

Buckets with few fingerprints are compared pair by pair. In a larger one, each fingerprint
is filed under itself and under each one-bit neighbour inside the masked bits: two of them are
within two bits exactly if they share such a midpoint, so linking all of a midpoint to its
smallest member needs no pairs. Equal fingerprints are one row from the start.

Nulls and empty texts have no words and the fingerprint zero, linked like any other. A NULL id
is a row of its own without a component partner: it gets the component of its fingerprint, but
is never the smallest id. Repeated rows come back as often as they went in.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assaymill.llm.common import append_columns
from assaymill.session import materialize

BITS = 64
SEED = 42
#: Buckets up to this size compare all pairs (at most half as many pairs per member).
PAIRWISE_MOST = 16
#: Shingles hashed at a time: bounds the memory of one very long text.
BLOCK = 1 << 16

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text: str | None, width: int) -> list[str]:
    """Word shingles of the ASCII-lower-cased text, repeats included."""
    words = _WORD.findall((text or "").encode().lower().decode())
    if len(words) <= width:
        return [" ".join(words)] if words else []
    return list(map(" ".join, zip(*(words[i:] for i in range(width)))))


def fingerprint(text: str | None, width: int = 3) -> int:
    """64 majority bits over the shingle hashes; no shingles give zero."""
    parts = shingles(text, width)
    ones = np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(parts), BLOCK):
        block = parts[at : at + BLOCK]
        hashes = np.fromiter((digest(s, SEED) for s in block), np.uint64, len(block))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    set_bits = (ones * 2 > len(parts)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view(np.int64)[0])


def with_fingerprint(
    df: DataFrame, text: str = "text", width: int = 3, into: str = "_fp"
) -> DataFrame:
    """Append the signed 64-bit fingerprint of each whole text."""

    def start():
        return lambda texts: [
            pa.array([fingerprint(t.as_py(), width) for t in texts], pa.int64())
        ]

    return append_columns(df, [text], [T.StructField(into, T.LongType())], start)


def covering_masks(radius: int, bits: int = BITS) -> list[int]:
    """Masks (as signed 64-bit numbers) of the covering tables."""
    full = (1 << (radius + 1)) - 1
    out = []
    for v in range(1, full + 1):
        mask = sum(1 << i for i in range(bits) if ((i % full + 1) & v).bit_count() % 2)
        out.append(mask - (1 << 64) if mask >> 63 else mask)
    return out


def _one_bit_neighbours(fp: Column, mask: Column) -> Column:
    """``fp`` itself and ``fp`` with one bit outside ``mask`` flipped."""
    single = [-(1 << 63) if i == 63 else 1 << i for i in range(BITS)]
    outside = F.filter(
        F.array(*[F.lit(b).cast("bigint") for b in single]), lambda b: b.bitwiseAND(mask) == 0
    )
    return F.concat(F.array(fp), F.transform(outside, lambda b: fp.bitwiseXOR(b)))


def links(fingerprints: DataFrame, radius: int = 2, fp: str = "_fp") -> DataFrame:
    """Edges ``(a, b)``, ``a < b``, between distinct fingerprints at ``radius`` or fewer bits.

    Two fingerprints within the radius are always connected, though not always by an edge of
    their own. Only radii up to two have midpoints one bit away, so more is refused.
    """
    if not 1 <= radius <= 2:
        raise ValueError("radius must be 1 or 2")
    tables = F.array(
        *[
            F.struct(F.lit(k).alias("t"), F.lit(m).cast("bigint").alias("mask"))
            for k, m in enumerate(covering_masks(radius))
        ]
    )
    filed = (
        fingerprints.select(F.col(fp).alias("f"), F.explode(tables).alias("k"))
        .select("f", F.col("k.t").alias("t"), F.col("k.mask").alias("mask"))
        .withColumn("bucket", F.col("f").bitwiseAND(F.col("mask")))
    )
    sizes = filed.groupBy("t", "bucket").agg(F.count("*").alias("n")).where("n > 1")
    shared = materialize(filed.join(sizes, ["t", "bucket"]), "simhash-buckets")
    small = shared.where(F.col("n") <= PAIRWISE_MOST)
    left = small.select("t", "bucket", F.col("f").alias("a"))
    right = small.select("t", "bucket", F.col("f").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    pairs = left.join(right, ["t", "bucket"]).where((F.col("a") < F.col("b")) & near)
    stars = (
        shared.where(F.col("n") > PAIRWISE_MOST)
        .select("t", "bucket", "f", F.explode(_one_bit_neighbours(F.col("f"), F.col("mask"))).alias("mid"))
    )
    if radius == 1:  # a midpoint links two bits; for one bit it must be a member itself
        flips = stars.where(F.col("mid") != F.col("f")).select(F.col("f").alias("a"), F.col("mid").alias("b"))
        starred = flips.join(fingerprints.select(F.col(fp).alias("b")), "b", "left_semi").where("a < b")
    else:
        lowest = stars.groupBy("t", "bucket", "mid").agg(
            F.min("f").alias("a"), F.count("*").alias("members")
        ).where("members > 1")
        starred = (
            stars.join(lowest, ["t", "bucket", "mid"])
            .where(F.col("a") < F.col("f"))
            .select("a", F.col("f").alias("b"))
        )
    return pairs.select("a", "b").unionByName(starred.select("a", "b")).distinct()


def components(edges: DataFrame, max_rounds: int = 64) -> DataFrame:
    """``(node, root)`` for every node of ``edges(a, b)``: the smallest node it is connected to.

    Alternates large-star and small-star steps; each written round replaces the lineage. The
    work of a round is proportional to the edges, and a node's neighbours are only ever
    reduced to their minimum.
    """
    now = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = materialize(now, "components")
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = (
            both.join(low, "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .distinct()
        )
        low2 = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low2, "u")
        small = (
            joined.where(F.col("v") != F.col("m"))
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(joined.select("u", F.col("m").alias("v")))
            .where("u != v")
            .distinct()
        )
        after = materialize(small, "components")
        # Settled once every node hangs on a node that hangs on nothing.
        heads = after.select(F.col("v").alias("u")).distinct()
        several = after.groupBy("u").agg(F.count("*").alias("n")).where("n > 1")
        now = after
        if after.join(heads, "u", "left_semi").isEmpty() and several.isEmpty():
            break
    else:
        raise RuntimeError(f"components not settled after {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    radius: int = 2,
    width: int = 3,
) -> DataFrame:
    """One row per document: its id, ``fingerprint`` (16 hex digits) and ``component_id``.

    ``component_id`` is the smallest id reachable over links of ``radius`` or fewer bits.
    """
    marked = materialize(
        with_fingerprint(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("_text")), "_text", width)
        .select("doc_id", "_fp"),
        "simhash",
    )
    # One row per distinct fingerprint: a group of exact copies is counted before it is shuffled.
    classes = materialize(marked.groupBy("_fp").agg(F.min("doc_id").alias("first")), "simhash-classes")
    roots = components(links(classes, radius))
    rooted = classes.join(roots, classes["_fp"] == roots["node"], "left").select(
        "_fp", "first", F.coalesce("root", "_fp").alias("root")
    )
    ids = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = rooted.join(ids, "root").select(F.col("_fp").alias("_of"), "component_id")
    return (
        marked.join(of_class, marked["_fp"] == of_class["_of"], "left")
        .select(
            "doc_id",
            F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
            "component_id",
        )
    )


def _order(doc_id: str) -> Column:
    """Smallest id first, no id last, then by a hash over all columns."""
    value = F.col(f"_row.`{doc_id}`")
    return F.struct(value.isNull().alias("none"), value.alias("id"), F.xxhash64(F.to_json("_row")).alias("hash"))


def first_rows(tagged: DataFrame, key: str, doc_id: str, others: Sequence[str] = ()) -> DataFrame:
    """One row of each ``key``, its first, of ``tagged(_row, key, others)``, written once.

    ``others`` depend on the key alone. Copies are reduced in their own task before the shuffle.
    """
    first = F.min_by("_row", _order(doc_id)).alias("_row")
    return materialize(
        tagged.groupBy(key).agg(first, *[F.first(c).alias(c) for c in others]), "first-rows"
    )


def one_of_each(heads: DataFrame, edges: DataFrame, key: str, doc_id: str) -> DataFrame:
    """The rows in ``heads`` less those that come after another one of their component."""
    roots = materialize(components(edges), "roots")
    members = roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
    placed = heads.select(F.col(key).alias("node"), _order(doc_id).alias("order")).join(members, "node")
    placed = materialize(placed.withColumn("order", F.struct("order", "node")), "placed")
    first = placed.groupBy("root").agg(F.min("order").alias("first"))
    later = placed.join(first, "root").where(F.col("node") != F.col("first.node"))
    return heads.join(later.select(F.col("node").alias(key)), key, "left_anti").select("_row.*")


def keep_one(docs: DataFrame, radius: int = 2, width: int = 3) -> DataFrame:
    """The documents with one row for each near-duplicate group.

    Groups are of rows, whatever their ids: that with the smallest id stays, of several rows with
    that id the one with the lowest hash over all columns. Rows without an id come last.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    marked = with_fingerprint(docs.select(row, F.col("text").alias("_text")), "_text", width)
    heads = first_rows(marked.select("_row", "_fp"), "_fp", "doc_id")
    return one_of_each(heads, links(heads.select("_fp"), radius), "_fp", "doc_id")
