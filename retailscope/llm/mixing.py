"""Mixing sources to target weights by hash thresholds.

Every document has a fixed 60-bit hash of its id and text. A source's mix is some whole number of passes over
all of its documents plus those whose hash lies below the source's threshold. The threshold comes from
histograms: words are summed by source and leading hash digit, the digit where the budget is met is found, and
only that digit's documents are histogrammed by the next one. Rows equal in id and text share a hash; where the
threshold falls among them, they are told apart by a second hash, of their place in the input. Nothing is sorted
by hash, and growing a budget only adds documents.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailscope.llm.common import only_named, whole_text
from retailscope.sources.shared import materialize

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 60
DIGIT_BITS = 12
WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3


def hash_of(doc_id: Column, text: Column) -> Column:
    """60 bits of the MD5 of the id's decimal text and the text's MD5; a null id counts as empty text."""
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.md5(text))
    return F.conv(F.substring(F.md5(named), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def place_hash() -> Column:
    """60 bits that tell rows apart by their place in the input."""
    return F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - HASH_BITS)


def numbered_sources(sizes: DataFrame) -> DataFrame:
    """Add ``number``, the position of every source by code point, nulls last, without one global sort task."""
    ordered = materialize(
        sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "sources"
    )
    # one row per partition of the sort
    before = ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).select(
        "part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())
    return ordered.join(before, "part").select(
        "source", "source_size", (F.col("before") + F.row_number().over(inside) - 1).alias("number")
    )


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size) -> the same with ``number``, ``target``.

    Sources take ``weights`` in turn by code point and share the sum of all sizes. A target stops at
    ``most_repeats`` times its source; the excess is shared among the others by weight until none is
    above. The level (a fraction of two integers) only rises from round to round, so the driver holds
    two numbers and the sources that have stopped follow from them.
    """
    big = "decimal(38,0)"
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("number") % len(weights) + 1).cast("int"))
    table = materialize(numbered_sources(sizes).withColumn("weight", weight), "source-weights")
    words = table.agg(F.sum(F.col("source_size").cast(big))).first()[0] or 0
    share, parts = words, table.agg(F.sum("weight")).first()[0] or 1
    limit = F.col("source_size").cast(big) * most_repeats
    while True:
        stopped = limit * F.lit(parts).cast(big) < F.lit(share).cast(big) * F.col("weight")
        row = table.agg(
            F.sum(F.when(stopped, limit)).alias("fixed"), F.sum(F.when(~stopped, F.col("weight"))).alias("parts")
        ).first()
        now = (words - int(row["fixed"] or 0), row["parts"] or 1)
        if now == (share, parts):
            break
        share, parts = now
    level = (F.lit(share).cast(big) * F.col("weight")).cast("double") / F.lit(parts).cast("double")
    return table.withColumn("target", F.when(stopped, limit.cast("double")).otherwise(level)).drop("weight")


def boundaries(rows: DataFrame, budgets: DataFrame, column: str) -> tuple[DataFrame, DataFrame]:
    """Where ``column`` meets each source's budget: (number, budget, prefix, before, words, n), and the rows there.

    ``rows`` has (number, size, column), ``budgets`` (number, budget, base): the words taken before any of
    them. ``prefix`` is the value at which the sum of sizes reaches the budget, ``before`` what is taken
    below it, ``words`` and ``n`` the words and rows that have it. A source's histogram has at most
    ``2 ** DIGIT_BITS`` digits at each level; after the last level a digit is a single value.
    """
    place = budgets.select("number", "budget", F.col("base").cast("bigint").alias("before"))
    left = rows
    for shift in range(HASH_BITS - DIGIT_BITS, -1, -DIGIT_BITS):
        sums = left.groupBy("number", F.shiftright(column, shift).alias("digit")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        running = Window.partitionBy("number").orderBy("digit")
        sums = sums.withColumn("reached", F.sum("words").over(running)).join(
            place.select("number", "budget", F.col("before").alias("base")), "number"
        )
        met = sums.where(F.col("base") + F.col("reached") >= F.col("budget"))
        place = materialize(
            met.groupBy("number", "budget").agg(F.min(F.struct("digit", "base", "reached", "words", "n")).alias("at")).select(
                "number", "budget", F.col("at.digit").alias("prefix"),
                (F.col("at.base") + F.col("at.reached") - F.col("at.words")).alias("before"),
                F.col("at.words").alias("words"), F.col("at.n").alias("n"),
            ),
            "mix-boundary",
        )
        inside = place.select("number", F.col("prefix").alias("digit"))
        here = left.withColumn("digit", F.shiftright(column, shift)).join(inside, ["number", "digit"], "left_semi").drop("digit")
        left = materialize(here, "mix-boundary-rows") if shift else here
    return place, left


def nearer_with() -> Column:
    """Whether the words at the boundary bring the sum nearer to the budget than it is before them."""
    return F.col("before") + F.col("words") - F.col("budget") < F.col("budget") - F.col("before")


def thresholds(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """(number, budget) -> (number, below, edge, place_below), which come nearest to the budget.

    To be taken are the hashes under ``below``, and of those that are ``edge`` the rows whose place hash is
    under ``place_below``. ``rows`` has (number, size, hash, place).
    """
    none = F.lit(None).cast("bigint")
    met, here = boundaries(rows, budgets.withColumn("base", F.lit(0)), "hash")
    single = met.select("number", (F.col("prefix") + nearer_with().cast("bigint")).alias("below"), none.alias("edge"), none.alias("place_below"))
    several = met.where("n > 1")
    if several.isEmpty():
        return single
    equal = here.join(several.select("number"), "number", "left_semi").select("number", "size", "place")
    among, _ = boundaries(equal, several.select("number", "budget", F.col("before").alias("base")), "place")
    told = several.select("number", F.col("prefix").alias("below"), F.col("prefix").alias("edge")).join(
        among.select("number", (F.col("prefix") + nearer_with().cast("bigint")).alias("place_below")), "number")
    return single.join(several.select("number"), "number", "left_anti").unionByName(told)


def mix(
    docs: DataFrame, weights: Sequence[int] = WEIGHTS, most_repeats: int = MOST_REPEATS,
    id_column: str = "doc_id", text_column: str = "text", source_column: str = "source",
    keep: Sequence[str] = (),
) -> DataFrame:
    """(doc_id, size, source_size, target, copies, taken), one row per input row.

    With ``keep``, those input columns, ``copies`` and ``taken`` instead.

    ``size`` is the number of words; null text has none. ``copies`` is how often the mix holds the
    document (0 to ``most_repeats``), ``taken`` its words in the mix. Null is a source of its own, after
    all others. Rows that share an id, or have none, are told apart by their texts, so their words come as
    near to a target as others'; of rows equal in both, as many are taken as bring the sum nearest, by their
    place in the input. A source without words has target 0 and takes nothing; an empty table gives no
    rows. The result depends on ids, texts and sources alone (for equal rows, their number), so reruns agree.
    """
    rows = materialize(
        only_named(docs, doc_id=id_column, text=text_column, source=source_column).select(
            "doc_id", F.col("source").cast("string").alias("source"),
            F.regexp_count(whole_text(), F.lit(WORD)).cast("bigint").alias("size"),
            hash_of(F.col("doc_id"), whole_text()).alias("hash"), place_hash().alias("place"),
        ),
        "mix-rows",
    )
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    targets = source_targets(sizes, weights, most_repeats).withColumn("passes", passes.cast("bigint"))
    targets = materialize(
        targets.withColumn("budget", F.col("target") - F.col("passes") * F.col("source_size")), "mix-targets"
    )
    same_source = rows["source"].eqNullSafe(targets["source"])
    numbered = rows.join(targets, same_source).select(targets["number"], "size", "hash", "place")
    cut = thresholds(numbered, targets.where(F.col("source_size") > 0).select("number", "budget"))
    plan = materialize(targets.join(cut, "number", "left"), "mix-plan")

    def times(hash_: Column, place: Column) -> Column:
        under = (hash_ < F.coalesce("below", F.lit(0))) | F.coalesce((hash_ == F.col("edge")) & (place < F.col("place_below")), F.lit(False))
        return F.col("passes") + under.cast("bigint")

    if keep:
        own = F.struct(
            F.col(source_column).cast("string").alias("source"),
            hash_of(F.col(id_column), whole_text(text_column)).alias("hash"), place_hash().alias("place"),
            F.regexp_count(whole_text(text_column), F.lit(WORD)).cast("bigint").alias("size"),
        )
        marked = docs.select(*[F.col(c) for c in keep], own.alias("own"))
        plan = plan.select(F.col("source").alias("plan_source"), "passes", "below", "edge", "place_below")
        copies = times(F.col("own.hash"), F.col("own.place"))
        return marked.join(plan, F.col("own.source").eqNullSafe(F.col("plan_source"))).select(
            *keep, copies.alias("copies"), (copies * F.col("own.size")).alias("taken")
        )
    return (
        rows.join(plan, rows["source"].eqNullSafe(plan["source"]))
        .withColumn("copies", times(F.col("hash"), F.col("place")))
        .select("doc_id", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))
    )
