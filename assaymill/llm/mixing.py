"""Mixing sources to target weights, with Spark's own functions only.

Every document gets a hash-random key. Rows are range-sorted by (source, key); the key axis is cut
into ranges of equal width, which hold about equally many rows as the keys are uniform, so a
source with a third of all rows is spread over many ranges. The words of each (source, range) are
added up first, and their running sums become one carry row at the head of each range. One
window per range then gives every document the words of its source before it: a distributed
prefix sum with one shuffle of the rows and no join. A source whose budget is e times its words
plus a rest is taken e times in whole, and once more up to the rest, cut inside the document that
reaches it.

Budgets are water levels: all words are shared by weight, a source stops at ``most_repeats`` times
its words, and the excess goes to the others by weight until no source is above. Each step of that
loop is one sum over the table of sources; the driver sees two numbers of it.

Cases: a NULL text has no words and is never taken; a NULL source is a source of its own, last in
the order; NULL ids are keyed by their text. Rows alike in id, text and source are
interchangeable. An empty table gives an empty one; without any word all targets are 0. Long texts
are one row each and are only hashed and counted. ``plan`` returns its own columns and those asked
for by ``keep``; ``mixed`` returns the columns of the input plus ``epoch``, ``n_words`` and keeps
an input column of such a name out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from assaymill.operators.ranking import with_rank
from assaymill.session import materialize

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = 11
#: About this many documents share a key range; each range is one group of a window.
RANGE_ROWS = 65_536

WORD = r"[^\x20\x09-\x0D]+"
#: Between a word and the white space after it.
WORD_END = r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"


def random_key(id_col: str, text_col: str, seed: int) -> Column:
    """The same 128 uniform bits for a row on every run, as hex digits."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (id_col, text_col)]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *shown))


def source_key(source_col: str) -> Column:
    """A source as a value that is never NULL and sorts by code point, the missing one last."""
    name = F.col(source_col).cast("string")
    return F.struct(name.isNull().alias("missing"), F.coalesce(name, F.lit("")).alias("name"))


def targets(sources: DataFrame, weights: Sequence[int], most_repeats: int) -> DataFrame:
    """``(_source, source_size, target)`` from ``(_source, source_size)``.

    Weights go round by the rank of the source. Sizes and limits are compared as integers.
    """
    rank = F.pmod(F.col("_rank") - 1, F.lit(len(weights))).cast("int")
    weight = F.array(*[F.lit(int(w)) for w in weights])[rank].cast("decimal(20,0)")
    ranked = materialize(
        with_rank(sources, [F.col("_source").asc()], "_rank").select(
            "_source",
            "source_size",
            weight.alias("_weight"),
            (F.col("source_size") * most_repeats).cast("decimal(20,0)").alias("_limit"),
        ),
        "mix-sources",
    )
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    open_words, open_weight = int(total), None
    limited = F.lit(False)
    while True:
        full, width = ranked.agg(
            F.sum(F.when(limited, F.col("_limit"))), F.sum(F.when(~limited, F.col("_weight")))
        ).first()
        left, width = int(total) - int(full or 0), int(width or 0)
        if width == open_weight or width == 0:
            break
        open_words, open_weight = left, width
        # Limits reached at an earlier, lower level stay reached: the level only rises.
        limited = F.col("_limit") * F.lit(width) < F.lit(left) * F.col("_weight")
    share = (F.lit(open_words) * F.col("_weight")).cast("double") / F.lit(float(open_weight or 1))
    target = F.when(limited, F.col("_limit").cast("double")).otherwise(share)
    return ranked.select("_source", "source_size", target.alias("target"))


def plan(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    most_repeats: int = MOST_REPEATS,
    seed: int = SEED,
    source_col: str = "source",
    text_col: str = "text",
    id_col: str = "doc_id",
    keep: Sequence[Column] = (),
    range_rows: int = RANGE_ROWS,
) -> DataFrame:
    """One row per document: id, ``size``, ``source_size``, ``target``, ``taken``, then ``keep``.

    ``taken`` counts the words that the mix takes, repeats counted. In each source they add up to the
    target rounded to a whole number, and no document gives more than ``most_repeats`` times its
    words.
    """
    kept = F.struct(F.col(id_col).alias("_id"), *keep)
    rows = materialize(
        docs.select(
            source_key(source_col).alias("_source"),
            random_key(id_col, text_col, seed).alias("_key"),
            F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
            kept.alias("_kept"),
        ),
        "mix-rows",
    )
    ranges = max(1, -(-rows.count() // range_rows))
    axis = F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint")
    spread = rows.withColumn("_range", F.shiftright(axis * F.lit(ranges), 32))

    sums = materialize(
        spread.groupBy("_source", "_range").agg(F.sum("size").alias("_words")), "mix-ranges"
    )
    per_source = sums.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    earlier = Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carries = (
        sums.withColumn("size", F.coalesce(F.sum("_words").over(earlier), F.lit(0)))
        .join(targets(per_source, weights, most_repeats), "_source")
        .select("_source", "_range", F.lit("").alias("_key"), "size", "source_size", "target")
    )

    # Equal (source, range) pairs never cross a partition, so the window needs no shuffle of its own.
    placed = spread.unionByName(carries, allowMissingColumns=True).repartitionByRange("_source", "_range")
    inside = Window.partitionBy("_source", "_range").orderBy("_key")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumns(
        {
            "_before": F.sum("size").over(running) - F.col("size"),
            "source_size": F.first("source_size").over(running),
            "target": F.first("target").over(running),
        }
    ).where(F.col("_kept").isNotNull())

    budget = F.round("target").cast("bigint")
    whole = F.call_function("div", budget, F.greatest("source_size", F.lit(1)))
    rest = budget - whole * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("_before")))
    return placed.select(
        F.col("_kept._id").alias(id_col),
        "size",
        "source_size",
        "target",
        (whole * F.col("size") + last).alias("taken"),
        *[F.col(f"_kept.`{c}`") for c in placed.schema["_kept"].dataType.names[1:]],
    )


def mixed(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", **options
) -> DataFrame:
    """The rows of the mix: a document once per epoch that takes it, with ``epoch`` from 0 on.

    ``n_words`` tells the words taken; the document in which a source's budget ends holds its
    text up to the end of its last taken word. Documents that give no word are not there.
    """
    added = {"epoch", "n_words"}
    columns = [c for c in docs.columns if c.lower() not in added]
    whole = F.struct(*[F.col(f"`{c}`") for c in columns]).alias("_doc")
    found = plan(docs, text_col=text_col, id_col=id_col, keep=[whole], **options)
    size = F.col("size")
    copies = found.where("taken > 0").select(
        "_doc",
        "size",
        "taken",
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.call_function("div", F.col("taken") - 1, size))).alias("epoch"),
    )
    n_words = F.least(size, F.col("taken") - F.col("epoch") * size)
    copies = copies.withColumn("n_words", n_words)
    text = F.col(f"_doc.`{text_col}`")
    cut = F.array_join(F.slice(F.split(text, WORD_END), F.lit(1), F.col("n_words").cast("int")), "")
    shown = F.when(F.col("n_words") < size, cut).otherwise(text)
    return copies.select(
        *[shown.alias(c) if c == text_col else F.col(f"_doc.`{c}`") for c in columns], "epoch", "n_words"
    )
