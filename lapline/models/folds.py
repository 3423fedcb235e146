"""Group-aware fold assignment (K1, K2) and out-of-fold scoring (K3, K4).

Groups are taken in descending order of weight and each goes to the fold that
is the lightest then.  K1 orders by (rows descending, group) and weighs folds
by their rows.  K2 orders by (spread of the group's class counts descending,
rows descending, class counts, group); a group goes where the variance over
the folds of the classes' shares, summed over classes, ends least, then to
the fold with the fewest rows.  Ties go to the lower fold.

Groups of equal counts are interchangeable, and each that a fold takes raises
its key by the same step.  So a run of them is dealt by merging one
arithmetic progression a fold: at most ``n_splits`` stretches, in each of
which some folds take turns.  The driver walks the runs in integers and
keeps one row of counts a fold; ranks from a distributed sort then place the
groups.  There are at most sqrt(2 rows) runs for K1 and of the order of
rows^(2/3) for K2 with two classes.  The rule is the same at every number of
groups and classes.  A null group is a group of its own, rows with a null
label count as rows only, and an empty table gives an empty one.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from lapline.operators.prefix import global_rank
from lapline.session import ensure_checkpoint_dir


#: Runs that the driver holds at a time.
RUNS_PER_PIECE = 100_000
_STRETCHES = "array<struct<first: long, turns: array<int>>>"


def deal_run(keys: list[tuple[int, int]], step: tuple[int, int], count: int) -> tuple[list, list[int]]:
    """Deal ``count`` equal groups, each to the fold of the least key, then the lowest fold.

    A fold's key rises by ``step`` (first part above 0) with each group.
    Returns the stretches (first rank, folds that take turns from there) and
    the groups that each fold gets.
    """
    waiting = sorted((v, w, f) for f, (v, w) in enumerate(keys))
    active: list[tuple[int, int, int]] = []
    stretches, taken, done = [], [0] * len(keys), 0
    while done < count:
        active = sorted([*active, waiting.pop(0)])
        length = count - done
        if waiting:
            length = min(length, sum(_before(key, step, waiting[0]) for key in active))
        if length:
            stretches.append((done, [f for _, _, f in active]))
        rounds, rest = divmod(length, len(active))
        for i, (v, w, f) in enumerate(active):
            n = rounds + (i < rest)
            taken[f] += n
            active[i] = (v + n * step[0], w + n * step[1], f)
        done += length
    return stretches, taken


def _before(key: tuple[int, int, int], step: tuple[int, int], other: tuple[int, int, int]) -> int:
    """How many of ``key``, ``key + step``, ... come before ``other``, which isn't before ``key``."""
    n, rest = divmod(other[0] - key[0], step[0])
    return n + int(bool(rest) or (key[1] + n * step[1], key[2]) < other[1:])


def _stretches(runs: Iterable[Row], n_splits: int, weight: dict) -> Iterator[tuple[str, int, list]]:
    """(run, its first rank, its stretches) of the runs in order; ``weight`` of each class."""
    rows = [0] * n_splits
    counts = [Counter() for _ in range(n_splits)]
    for run in runs:
        own = {c["label"]: c["n"] for c in run["__v"]}
        rise = sum(weight[c] * n * n for c, n in own.items())
        keys = [(sum(weight[c] * n * held[c] for c, n in own.items()), r) for held, r in zip(counts, rows)]
        step = (rise, run["__n"])
        if not rise:  # no labels: by rows alone
            keys, step = [(r, 0) for r in rows], (run["__n"], 0)
        found, taken = deal_run(keys, step, run["__count"])
        for f, n in enumerate(taken):
            rows[f] += n * run["__n"]
            for c, m in own.items():
                counts[f][c] += n * m
        yield run["__run"], run["__first"], found


def _dealt(groups: DataFrame, order: list[Column], group: str, n_splits: int, weight: dict) -> DataFrame:
    """(group, fold) of a table (group, __n, __v): rows and class counts of each group."""
    ranked = global_rank(groups.withColumn("__run", F.to_json(F.struct("__n", "__v"))), [*order, F.col(group).asc()], "__rank")
    runs = ranked.groupBy("__run").agg(F.first("__n").alias("__n"), F.first("__v").alias("__v"),
                                       F.count(F.lit(1)).alias("__count"), F.min("__rank").alias("__first")).checkpoint()
    number = runs.agg(F.sum("__count")).first()[0]
    if number and n_splits > number:
        raise ValueError(f"Cannot have number of splits n_splits={n_splits} greater "
                         f"than the number of groups: {number}.")
    spark = groups.sparkSession
    schema = f"__run string, __first long, __turns {_STRETCHES}"
    walk = _stretches(runs.orderBy("__first").toLocalIterator(), n_splits, weight)
    table = spark.createDataFrame([], schema)
    while piece := list(islice(walk, RUNS_PER_PIECE)):
        table = table.unionByName(spark.createDataFrame(piece, schema).checkpoint())
    place = F.col("__rank") - F.col("__first")
    turn = F.element_at(F.filter("__turns", lambda t: t["first"] <= place), -1)
    fold = F.element_at(turn["turns"], ((place - turn["first"]) % F.size(turn["turns"]) + 1).cast("int"))
    return ranked.join(table, "__run").select(group, fold.alias("fold"))


def group_kfold_table(df: DataFrame, group: str = "group", n_splits: int = 5) -> DataFrame:
    """K1: (group, fold), the largest group first, each to the fold with the fewest rows."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n")) \
        .withColumn("__v", F.expr("cast(array() as array<struct<label: int, n: long>>)"))
    return _dealt(counts, [F.col("__n").desc()], group, n_splits, {})


def stratified_group_kfold_table(df: DataFrame, group: str = "group", label: str = "label",
                                 n_splits: int = 5) -> DataFrame:
    """K2: (group, fold), the group of the widest class counts first, each to the fold that keeps the classes most even."""
    cells = df.groupBy(group, F.col(label).alias("__label")).agg(F.count(F.lit(1)).alias("__c"))
    totals = {r[0]: r[1] for r in df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1))).collect()}
    # shares are counts over the class's rows: weights 1 / rows^2, in integers
    scale = math.lcm(*(n * n for n in totals.values()))
    labelled = F.col("__label").isNotNull()
    n = F.when(labelled, F.col("__c")).cast("decimal(19,0)")
    spread = len(totals) * F.coalesce(F.sum(n * n), F.lit(0)) - F.coalesce(F.sum(n) * F.sum(n), F.lit(0))
    groups = cells.groupBy(group).agg(
        F.sum("__c").alias("__n"), spread.alias("__spread"),
        F.sort_array(F.collect_list(F.when(labelled, F.struct(F.col("__label").alias("label"), F.col("__c").alias("n"))))).alias("__v"))
    return _dealt(groups, [F.col("__spread").desc(), F.col("__n").desc(), F.col("__v").asc()], group, n_splits,
                  {c: scale // (m * m) for c, m in totals.items()})


def attach_folds(df: DataFrame, table: DataFrame, group: str = "group", name: str = "fold") -> DataFrame:
    """Add the fold of each row's group."""
    t = table.select(F.col(group).alias("__group"), F.col("fold").alias("__fold"))
    return df.join(t, df[group].eqNullSafe(t["__group"]), "left") \
        .withColumn(name, F.col("__fold")).drop("__group", "__fold")


def group_kfold(df: DataFrame, group: str = "group", n_splits: int = 5, name: str = "fold") -> DataFrame:
    """K1: add a fold column such that no group is in two folds."""
    return attach_folds(df, group_kfold_table(df, group, n_splits), group, name)


def stratified_group_kfold(df: DataFrame, group: str = "group", label: str = "label",
                           n_splits: int = 5, name: str = "fold") -> DataFrame:
    """K2: as K1, with every class spread evenly."""
    return attach_folds(df, stratified_group_kfold_table(df, group, label, n_splits), group, name)


def out_of_fold(df: DataFrame, fit: Callable[[DataFrame], object], fold: str = "fold",
                keep_cols: tuple[str, ...] | None = None, parallelism: int = 5) -> DataFrame:
    """K3/K4: for each fold, fit on the other folds and transform the held
    out one; the union is the out-of-fold prediction table.

    The input is persisted while the folds are fitted.  Folds come from the
    data, so this is a loop over a handful of fold ids, not over rows; the
    fits are submitted from a thread pool so their Spark jobs run
    concurrently, as ``CrossValidator(parallelism=...)`` does.
    """
    from concurrent.futures import ThreadPoolExecutor

    from pyspark import StorageLevel

    cached = df.is_cached  # a caller's cache stays
    base = df if cached else df.persist(StorageLevel.MEMORY_AND_DISK)
    folds = [r[0] for r in base.select(fold).distinct().collect()]
    if None in folds:
        raise ValueError(f"{fold} must not be null")
    folds.sort()

    def one(f):
        model = fit(base.where(F.col(fold) != F.lit(f)))
        pred = model.transform(base.where(F.col(fold) == F.lit(f)))
        return pred.select(*keep_cols) if keep_cols else pred

    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(folds)))) as pool:
        parts = list(pool.map(one, folds))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    # the OOF table is reused by every metric: write it once to the
    # checkpoint folder (lineage cut, survives executor loss), then release
    # the input if it was cached here
    ensure_checkpoint_dir(df.sparkSession)
    out = out.checkpoint(eager=True)
    if not cached:
        base.unpersist()
    return out
