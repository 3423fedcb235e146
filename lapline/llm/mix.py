"""Mixing sources to target weights by weighted fair queueing.

Every source is a queue of its documents in shuffled order, repeated at
most ``max_repeats`` times; its share of the service is its target.  A
document copy has a virtual start and finish time: the source's words
before it, and up to its end, over the target.  The cut is a quota for each
source, its target in whole words, in place of a running total over the global range
sort by finish time, which only gives the copies taken their positions.
The copy that a source is serving at the cut is taken whole too: no text is
cut, and a source's words pass its target by less than one document.  The
words served by the cut are counted apart.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapline.llm.common import cut, fresh, running_total, stored

WEIGHTS = (5, 2, 1)
MAX_REPEATS = 3
_WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_WORD)), F.lit(0)).cast("long")


def _key(col: Column) -> Column:
    """Sorts by code point, null last."""
    return F.when(col.isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), col))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """(source_key, source_no, source_size, target) of a table (source_key, size).

    The source of rank k in code-point order, null last, has the weight
    ``weights[k % len]``.  All words together are the budget; a target stops
    at ``max_repeats`` times the source's size and the excess goes to the
    others by weight.  With sources sorted by cap over weight, the stopped ones
    come first, and the level of the others follows from the two running
    sums; ranks and sums are ``running_total``s, so that the number of sources
    isn't bounded by one task.
    """
    total = sizes.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    total = total.withColumn("all", F.lit(0).cast("long")).withColumn("one", F.lit(1).cast("long"))
    ranked = running_total(total, "all", ["source_key"], "one", "source_no")
    choice = F.array(*(F.lit(int(w)).cast("long") for w in weights))
    ranked = ranked.withColumn("weight", F.element_at(choice, (F.col("source_no") % len(weights) + 1).cast("int"))) \
        .withColumn("cap", F.col("source_size") * max_repeats).withColumn("ratio", F.col("cap") / F.col("weight"))
    ranked = running_total(ranked, "all", ["ratio", "source_key"], "cap", "caps_before")
    ranked = cut(running_total(ranked, "all", ["ratio", "source_key"], "weight", "weights_before"))
    sums = ranked.agg(F.sum("source_size").alias("t"), F.sum("weight").alias("w")).first()
    budget, all_weights = int(sums["t"] or 0), int(sums["w"] or 0)
    left, over = F.lit(budget) - F.col("caps_before"), F.lit(all_weights) - F.col("weights_before")
    # the first source, in this order, that its cap doesn't stop: its level holds for it and all later ones
    open_ = ranked.where(F.col("cap") * over >= F.col("weight") * left) \
        .agg(F.min(F.struct("ratio", "source_key", left.alias("left"), over.alias("over"))).alias("m")).first()["m"]
    if open_ is None:
        level = F.col("cap").cast("double")
    else:
        fill = F.col("weight") * F.lit(int(open_["left"])) / F.lit(int(open_["over"]))
        level = F.least(F.col("cap").cast("double"), fill)
    return ranked.select("source_key", "source_no", "source_size", level.cast("double").alias("target"))


def fair_schedule(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "mix",
                  id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                  row_col: str | None = None) -> DataFrame:
    """One row for each document copy that could be served: (row, doc_id, size, source_size, target, copy, finish, words).

    ``words`` is what is served of the copy by the cut (0 after it) and
    ``row`` identifies the document's row (``row_col`` if given, else a new number).  A null text has size 0, a null
    source is a source of its own, null ids and repeated rows are documents
    of their own; documents without words are listed with one copy of 0
    words.  The order within a source is that of md5(seed and id), so
    reruns agree.  An empty table gives no rows.
    """
    sized = cut(docs.select(
        (F.col(row_col) if row_col else F.monotonically_increasing_id()).alias("row"), F.col(id_col).alias("doc_id"),
        _key(F.col(source_col)).alias("source_key"), word_count(F.col(text_col)).alias("size"),
        F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary")).alias("shuffled")))
    targets = source_targets(sized, weights, max_repeats)
    queued = running_total(
        sized.join(targets, "source_key").drop("source_key"), "source_no", ["shuffled", "size", "row"], "size", "before")
    quota = F.floor(F.col("target"))
    copies = queued.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(max_repeats - 1)))) \
        .withColumn("start", F.col("copy") * F.col("source_size") + F.col("before")) \
        .withColumn("words", F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), quota - F.col("start")))) \
        .where("words > 0 or copy = 0") \
        .withColumn("finish", F.when(F.col("target") > 0, (F.col("start") + F.col("size")) / F.col("target")))
    return copies.select("row", "doc_id", "size", "source_size", "target", "copy", "finish", "words")


def mix(schedule: DataFrame) -> DataFrame:
    """The copies that the mix takes, whole, range-sorted by finish time, with ``position``: the words of the mix before each.

    A copy is taken if its service has begun by the cut; ``served`` are the words served by then.
    """
    taken = schedule.where("words > 0").withColumn("served", F.col("words")).withColumn("words", F.col("size")) \
        .withColumn("all", F.lit(0).cast("long"))
    return running_total(taken, "all", ["finish", "row", "copy"], "words", "position").drop("all")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """One row for each document: doc_id, size, source_size, target, the words served by the cut and the place of its first copy in the mix."""
    schedule = cut(fair_schedule(docs, **options))
    places = mix(schedule).groupBy("row").agg(F.sum("served").alias("taken"), F.min("position").alias("first_position"))
    return schedule.where("copy = 0").select("row", "doc_id", "size", "source_size", "target") \
        .join(places, "row", "left") \
        .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"),
                "first_position")


def mix_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
              weights: Sequence[int] = WEIGHTS, max_repeats: int = MAX_REPEATS, seed: str = "mix") -> DataFrame:
    """The mix itself: a row with all columns of ``docs``, its text whole, for each copy taken.

    A document of which nothing is taken, as one without words, goes.
    Copies keep their document's id.  Rows are numbered once, in a stored
    table: numbers given anew on each read would follow the file splits,
    which change with the number of executors.
    """
    number = fresh(docs.columns, "row")
    numbered = stored(docs.withColumn(number, F.monotonically_increasing_id()), "numbered")
    schedule = fair_schedule(numbered, weights, max_repeats, seed, id_col, text_col, source_col, number)
    begun = schedule.where("words > 0").select(F.col("row").alias(number))
    return numbered.join(begun, number).select(*(F.col(f"`{c}`") for c in docs.columns))
