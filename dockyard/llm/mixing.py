r"""Mixing sources to target weights: hash-random order, prefix sums of sizes, an exact cut for each source.

A document's size is its number of words (`[^\x20\x09-\x0D]+`). Sources in code-point order, null last, weigh
`weights` in turn; together they take as many words as there are. No source gives more than `max_epochs` times its
own words: what it cannot give is shared among the others by weight, until none is above. That fixed point is
min(max_epochs * size, rate * weight) with one `rate` for all, the largest of (all words - words of the first k
sources by size / weight, times max_epochs) / (weights of the rest), so a window over the few sources finds it.

Within a source, documents are in the order of a hash of their doc_id. The hash is uniform, so its leading hex
digits are a range partitioning into even parts: sums per (source, part) give the part that holds the cut, and only
that part of each source is sorted and summed row by row. No task ever holds a source. The cut (whole epochs, the
hash where the last epoch ends and the words taken of the document there) is one row per source, so a second pass
finds each document's share without shuffling any text.

Defined cases: a null or empty text has size 0 and nothing is taken of it; a source without words has target 0;
rows with equal doc_id share a hash and are ordered by size, and alike rows at the cut share its words evenly (less
than one word each is lost); reruns agree; an empty table gives no rows; further columns pass through.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockyard.llm.shared import SPACE, WORD, packed, stored, unpacked

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
#: Hex digits of the hash that name a part: 16**3 parts of each source.
PART_DIGITS = 3
SEED = "mix-1:"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def keyed(docs: DataFrame) -> DataFrame:
    """`row` (all columns of `docs`), source, size and the random key."""
    key = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("row.doc_id").cast("string"), F.lit(""))))
    return packed(docs).select(
        "row", F.col("row.source").alias("source"), words(F.col("row.text")).alias("size"), key.alias("key")
    )


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """source, source_size and target out of one row (source, source_size) per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(by_name) - 1) % len(weights)
    weight = reduce(lambda c, i: c.when(place == i, weights[i]), range(len(weights)), F)
    w = totals.withColumn("weight", weight.cast("long"))
    w = w.withColumn("most", F.col("source_size") * max_epochs)
    order = [F.col("most") / F.col("weight"), F.col("source").asc_nulls_last()]
    upto = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(F.lit(1))
    left = F.sum("source_size").over(whole) - F.coalesce(F.sum("most").over(upto), F.lit(0))
    open_weight = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(upto), F.lit(0))
    w = w.withColumn("rate", left.cast("double") / open_weight.cast("double"))
    share = F.max("rate").over(whole) * F.col("weight").cast("double")
    return w.select("source", "source_size", F.least(F.col("most").cast("double"), share).alias("target"))


def cuts(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """One row per source: source, source_size, target, epochs, and the cut: cut_key, cut_size, cut_words.

    `sized` has source, size and key. In the epoch after the whole ones, documents before (cut_key, cut_size) are
    taken whole, those at it give cut_words each.
    """
    part = F.substring("key", 1, PART_DIGITS)
    parts = sized.groupBy("source", part.alias("part")).agg(F.sum("size").alias("words"))
    parts = stored(parts, "mix-parts")
    goal = targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), weights, max_epochs)
    budget, size = F.floor("target"), F.col("source_size")
    goal = goal.withColumn("epochs", F.when(size > 0, F.floor(budget / size)).otherwise(0).cast("long"))
    goal = stored(goal.withColumn("left", budget - F.col("epochs") * size), "mix-goals")
    before = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    at = (
        parts.withColumn("ahead", F.coalesce(F.sum("words").over(before), F.lit(0).cast("long")))
        .withColumnRenamed("source", "s")
        .join(goal.select("source", "left"), F.col("s").eqNullSafe(F.col("source")))
        .where((F.col("ahead") < F.col("left")) & (F.col("left") <= F.col("ahead") + F.col("words")))
        .select("s", F.col("part").alias("p"), "ahead", "left")
    )
    at = stored(at, "mix-cut-parts")
    alike = (
        sized.select("source", "size", "key")
        .join(at, F.col("source").eqNullSafe(F.col("s")) & (part == F.col("p")))
        .groupBy("s", "ahead", "left", "key", "size")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    rows = Window.partitionBy("s").orderBy("key", "size").rowsBetween(Window.unboundedPreceding, -1)
    first = F.col("ahead") + F.coalesce(F.sum(F.col("size") * F.col("n")).over(rows), F.lit(0))
    cut = (
        alike.withColumn("first", first)
        .where((F.col("first") < F.col("left")) & (F.col("left") <= F.col("first") + F.col("size") * F.col("n")))
        .select(
            "s",
            F.col("key").alias("cut_key"),
            F.col("size").alias("cut_size"),
            F.floor((F.col("left") - F.col("first")) / F.col("n")).alias("cut_words"),
        )
    )
    done = goal.join(cut, F.col("source").eqNullSafe(F.col("s")), "left").drop("s", "left")
    return stored(done, "mix-cuts")


def mixed(keyed_docs: DataFrame, cut: DataFrame) -> DataFrame:
    """`keyed_docs` (with source, size, key) and `source_size`, `target` and `taken`."""
    cut = cut.withColumnRenamed("source", "s")
    first = (F.col("key") < F.col("cut_key")) | (
        (F.col("key") == F.col("cut_key")) & (F.col("size") < F.col("cut_size"))
    )
    here = (F.col("key") == F.col("cut_key")) & (F.col("size") == F.col("cut_size"))
    more = F.when(F.col("cut_key").isNull(), 0).when(first, F.col("size")).when(here, F.col("cut_words")).otherwise(0)
    taken = (F.col("epochs") * F.col("size") + more).cast("long")
    joined = keyed_docs.join(cut, F.col("source").eqNullSafe(F.col("s")))
    return joined.select(*keyed_docs.columns, "source_size", "target", taken.alias("taken"))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target and taken of every document."""
    sized = keyed(docs.select("doc_id", "source", "text"))
    sized = stored(sized.select(F.col("row.doc_id").alias("doc_id"), "source", "size", "key"), "mix-sizes")
    return mixed(sized, cuts(sized)).select("doc_id", "size", "source_size", "target", "taken")


def mixture(docs: DataFrame) -> DataFrame:
    """The mix itself: each document once per epoch that takes it, with `epoch`, `size`, `target` and `taken`.

    Its last epoch may take only its first words; the text is cut after them.
    """
    sized = stored(keyed(docs).select("source", "size", "key"), "mix-sizes")
    share = mixed(keyed(docs), cuts(sized)).where(F.col("taken") > 0)
    epochs = F.ceil(F.col("taken") / F.col("size")).cast("int")
    rows = share.select("row", "size", "target", "taken", F.explode(F.sequence(F.lit(1), epochs)).alias("epoch"))
    left = (F.col("taken") - (F.col("epoch") - 1) * F.col("size")).cast("int")
    pieces = F.regexp_extract_all(F.col("row.text"), F.lit(rf"[{SPACE}]*+{WORD}"), F.lit(0))
    text = F.when(left < F.col("size"), F.array_join(F.slice(pieces, 1, left), "")).otherwise(F.col("row.text"))
    more = ("epoch", "size", "target", "taken")
    rows = rows.select("row", text.alias("text"), *more)
    return unpacked(rows, docs, "text", *more)
