"""Global order without a global sort.

Ranks, running sums, equal-population bins and top fractions need a total order of all
rows. A window without ``partitionBy`` would put every row in one task, so rows first go
to *order buckets*: a bucket is a function of the ordering values alone, taken from
approximate quantiles, and buckets are themselves ordered. Bucket totals (a few numbers
per bucket) are collected, and give each bucket the running total in front of it.

* Where every row needs its position, rows are sorted inside their bucket only.
* Where rows only need a bin (a decile, a top fraction), buckets that lie inside one bin
  need no sort at all; just the few that a bin edge cuts through are sorted.

The quantiles only steer balance: results do not depend on them. A value that repeats so
often that it would fill several buckets gets one of its own, which is then split by the
next ordering column and at last by the unique key, so no bucket holds much more than
3/buckets of the rows, however skewed the values are.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reachmark.runtime import SMALL_TABLE_ROWS

_BUCKET = "_order_bucket"
_HEAVY_RUN = 3
# Size of a quantile sketch (rank error about 1/3000), and how many are left to merge at last.
SKETCH_K = 4096
SKETCH_GROUPS = 256
# Values that a task ranks, and ranks that it groups by key, on average.
RANK_ROWS = 250_000


def default_buckets(df: DataFrame) -> int:
    """At least 64, and two per shuffle partition, so that tasks even out."""
    return max(64, 2 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


@dataclass(frozen=True)
class Splits:
    """Half-open value ranges; ``heavy`` are those that hold a single value."""

    points: tuple[float, ...]
    heavy: frozenset[int]

    @staticmethod
    def from_quantiles(quantiles: Sequence[float] | None) -> Splits:
        runs: dict[float, int] = {}
        for q in quantiles or ():
            runs[q] = runs.get(q, 0) + 1
        inner: set[float] = set()
        singles: set[float] = set()
        for value, run in runs.items():
            if math.isinf(value):  # the outer ranges hold these
                continue
            inner.add(value)
            if run >= _HEAVY_RUN:
                inner.add(math.nextafter(value, math.inf))
                singles.add(value)
        points = (-math.inf, *sorted(inner or {0.0}), math.inf)
        return Splits(points, frozenset(i for i, p in enumerate(points) if p in singles))

    @staticmethod
    def uniform(low: float, high: float, n: int) -> Splits:
        step = (high - low) / n
        return Splits((-math.inf, *(low + step * i for i in range(1, n)), math.inf), frozenset())

    @property
    def null_bucket(self) -> int:
        return len(self.points) - 1

    def value_of(self, bucket: int) -> float:
        return self.points[bucket]

    def locate(self, value: float) -> int:
        return min(bisect_right(self.points, value) - 1, len(self.points) - 2)


def quantile_splits(df: DataFrame, exprs: Sequence[Column], buckets: int) -> list[Splits]:
    """Approximate quantile edges of several expressions in one aggregation.

    Each task makes a sketch of fixed size per expression; those are merged in
    ``SKETCH_GROUPS`` groups first, so the last task merges that many, whatever the input.
    """
    return [s for s, _ in _splits_and_nulls(df, exprs, buckets)]


def _splits_and_nulls(df: DataFrame, exprs: Sequence[Column], buckets: int) -> list[tuple[Splits, float]]:
    """``quantile_splits`` with the share of rows that are null or NaN."""
    names = [f"q{i}" for i in range(len(exprs))]
    k = F.lit(SKETCH_K)
    numbers = df.select(
        *[F.nanvl(e.cast("double"), F.lit(None).cast("double")).alias(n) for n, e in zip(names, exprs)],
        F.pmod(F.spark_partition_id(), F.lit(SKETCH_GROUPS)).alias("_group"),
    )
    groups = numbers.groupBy("_group").agg(
        *[F.kll_sketch_agg_double(n, k).alias(n) for n in names],
        *[F.count(n).alias(f"n_{n}") for n in names],
        F.count(F.lit(1)).alias("rows"),
    )
    merged = groups.agg(
        *[F.kll_merge_agg_double(n, k).alias(n) for n in names],
        *[F.sum(f"n_{n}").alias(f"n_{n}") for n in names],
        F.sum("rows").alias("rows"),
    )
    probs = F.array(*[F.lit(i / buckets) for i in range(1, buckets)])
    row = merged.select(
        *[F.when(F.col(f"n_{n}") > 0, F.kll_sketch_get_quantile_double(n, probs)) for n in names],
        *[1 - F.try_divide(F.col(f"n_{n}"), F.col("rows")) for n in names],
    ).first()
    return [(Splits.from_quantiles(row[i]), row[len(names) + i] or 0.0) for i in range(len(names))]


@dataclass(frozen=True)
class Measure:
    """An aggregate that can be taken per bucket and merged: sum, min, max or count."""

    name: str
    kind: str
    expr: Column | None = None

    def over_rows(self) -> Column:
        if self.kind == "count":
            return F.count(F.lit(1) if self.expr is None else self.expr).alias(self.name)
        return getattr(F, self.kind)(self.expr).alias(self.name)

    def over_parts(self) -> Column:
        kind = "sum" if self.kind == "count" else self.kind
        return getattr(F, kind)(self.name).alias(self.name)


@dataclass
class OrderIndex:
    """A fitted total order: edges per level and the totals of every order bucket.

    ``by`` lists ``(column, ascending)``; ``key`` is unique and breaks ties (rising for
    numbers, by hash and then value for other types). ``within`` restarts the order per
    group. Numeric or date/time ordering columns; nulls and NaN sort last.
    """

    by: list[tuple[str, bool]]
    key: str
    within: list[str]
    weight: str | None
    splits: list[Splits]
    totals: list = field(repr=False)
    schema: T.StructType = field(repr=False)
    numeric_key: bool = True

    # -- fitting ---------------------------------------------------------------

    @classmethod
    def fit(
        cls,
        df: DataFrame,
        by: Sequence[tuple[str, bool]],
        key: str,
        weight: str | None = None,
        within: Sequence[str] = (),
        measures: Sequence[Measure] = (),
        buckets: int | None = None,
        uniform: tuple[float, float] | None = None,
        splits: Splits | None = None,
    ) -> OrderIndex:
        """Two passes: one for the edges, one for the totals. Where the last ordering column has values (or
        nulls) that fill ranges of their own, a third one fits edges of the key.

        ``uniform`` gives the value range of a first level known to be spread evenly (a
        hash), ``splits`` edges already fitted for it; either saves the first pass.
        """
        buckets = buckets or default_buckets(df)
        numeric_key = isinstance(df.schema[key].dataType, T.NumericType)
        index = cls(list(by), key, list(within), weight, [], [], df.schema, numeric_key)
        levels = index._levels()
        if uniform is not None:
            splits = Splits.uniform(*uniform, buckets)
        if splits is None:
            fitted = _splits_and_nulls(df, levels[:-1], buckets)
            last, nulls = fitted[-1]
            tied = (last.heavy or nulls * buckets > 1) and key not in [name for name, _ in by]
            ends = quantile_splits(df, levels[-1:], buckets) if tied else [Splits.from_quantiles(None)]
            index.splits = [s for s, _ in fitted] + ends
        else:
            none = Splits.from_quantiles(None)
            index.splits = [splits] + [none] * (len(levels) - 1)
        weight_sum = F.sum(weight) if weight else F.count(F.lit(1))
        rows = (
            index.bucketed(df)
            .groupBy(*index.within, _BUCKET)
            .agg(
                F.count(F.lit(1)).alias("_rows"),
                weight_sum.alias("_weight"),
                *[m.over_rows() for m in measures],
            )
        )
        index.totals = sorted(
            (r.asDict() for r in rows.collect()),  # bounded by the number of buckets
            key=lambda r: (*[str(r[g]) for g in index.within], r[_BUCKET]),
        )
        rank = running = 0
        group = None
        for r in index.totals:
            this = tuple(r[g] for g in index.within)
            if this != group:
                rank, running, group = 0, 0, this
            r["_rank_before"], r["_before"] = rank, running
            rank += r["_rows"]
            running += r["_weight"] or 0
        return index

    def _levels(self) -> list[Column]:
        levels = []
        for name, ascending in self.by:
            value = F.col(name)
            if isinstance(self.schema[name].dataType, T.DateType):
                value = F.unix_date(value)
            elif isinstance(self.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
                value = F.unix_micros(value.cast("timestamp"))
            value = F.nanvl(value.cast("double"), F.lit(None).cast("double"))
            levels.append(value if ascending else -value)
        levels.append(
            (F.col(self.key) if self.numeric_key else F.xxhash64(self.key)).cast("double")
        )
        return levels

    def sort_columns(self) -> list[Column]:
        def value(name: str) -> Column:
            if isinstance(self.schema[name].dataType, (T.DoubleType, T.FloatType)):
                return F.nanvl(F.col(name), F.lit(None).cast(self.schema[name].dataType))
            return F.col(name)

        cols = [value(n).asc_nulls_last() if asc else value(n).desc_nulls_last() for n, asc in self.by]
        if not self.numeric_key:
            cols.append(F.xxhash64(self.key))
        return [*cols, F.col(self.key)]

    def bucketed(self, df: DataFrame) -> DataFrame:
        """``df`` with its order bucket, one long that sorts like the rows do."""
        names = [f"_level_{i}" for i in range(len(self.splits))]
        df = df.select("*", *[e.alias(n) for n, e in zip(names, self._levels())])
        df = Bucketizer(
            splitsArray=[list(s.points) for s in self.splits],
            inputCols=names,
            outputCols=[f"{n}_b" for n in names],
            handleInvalid="keep",
        ).transform(df)
        code: Column = F.lit(0).cast("long")
        tied: Column = F.lit(True)
        for name, s in zip(names, self.splits):
            here = F.coalesce(F.col(f"{name}_b").cast("long"), F.lit(s.null_bucket).cast("long"))
            code = code * F.lit(s.null_bucket + 2).cast("long") + F.when(tied, here + 1).otherwise(0)
            tied = tied & here.isin(s.null_bucket, *sorted(s.heavy))
        kept = [c for c in df.columns if not c.startswith("_level_")]
        return df.select(*kept, code.alias(_BUCKET))

    # -- totals ----------------------------------------------------------------

    def row_count(self, group: tuple = ()) -> int:
        return sum(r["_rows"] for r in self._of(group))

    def total(self, group: tuple = ()):
        return sum(r["_weight"] or 0 for r in self._of(group))

    def _of(self, group: tuple) -> list[dict]:
        if not self.within:
            return self.totals
        return [r for r in self.totals if tuple(r[g] for g in self.within) == group]

    def groups(self) -> list[tuple]:
        return list(dict.fromkeys(tuple(r[g] for g in self.within) for r in self.totals))

    def _attach(self, df: DataFrame, columns: dict[str, tuple[T.DataType, Callable]], keep=None):
        """Add driver-side facts about each bucket to its rows."""
        spark = df.sparkSession
        rows = [r for r in self.totals if keep is None or keep(r)]
        schema = T.StructType(
            [self.schema[g] for g in self.within]
            + [T.StructField(_BUCKET, T.LongType())]
            + [T.StructField(n, t) for n, (t, _) in columns.items()]
        )
        facts = spark.createDataFrame(
            [
                (*[r[g] for g in self.within], r[_BUCKET], *[f(r) for _, f in columns.values()])
                for r in rows
            ],
            schema,
        )
        if len(rows) <= SMALL_TABLE_ROWS:
            facts = F.broadcast(facts)
        joined = self.bucketed(df)
        if not self.within:
            return joined.join(facts, _BUCKET)
        same = joined[_BUCKET] == facts[_BUCKET]
        for g in self.within:
            same = same & joined[g].eqNullSafe(facts[g])
        return joined.join(facts.select("*"), same).select(
            *[joined[c] for c in joined.columns], *[facts[n] for n in columns]
        )

    def _local(self) -> Window:
        return Window.partitionBy(*self.within, _BUCKET).orderBy(*self.sort_columns())

    def _number_type(self) -> T.DataType:
        if self.weight and not isinstance(self.schema[self.weight].dataType, T.IntegralType):
            return T.DoubleType()
        return T.LongType()

    # -- row-level results -----------------------------------------------------

    def positions(self, df: DataFrame, rank: str | None = None, running: str | None = None):
        """Every row's 1-based rank and/or running weight."""
        t = self._number_type()
        out = self._attach(
            df,
            {
                "_rank_before": (T.LongType(), lambda r: r["_rank_before"]),
                "_before": (t, lambda r: _as(t, r["_before"])),
            },
        )
        w = self._local()
        if rank:
            out = out.withColumn(rank, F.row_number().over(w) + F.col("_rank_before"))
        if running:
            value = F.col(self.weight) if self.weight else F.lit(1)
            frame = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
            out = out.withColumn(running, F.sum(value).over(frame) + F.col("_before"))
        return out.drop(_BUCKET, "_rank_before", "_before")

    def top(self, df: DataFrame, sizes: int | dict[tuple, int]) -> DataFrame:
        """The first rows in order, exactly ``sizes`` (per group): only the cut bucket is sorted."""

        def want(r: dict) -> int:
            if isinstance(sizes, dict):
                return sizes.get(tuple(r[g] for g in self.within), 0)
            return sizes

        out = self._attach(
            df,
            {
                "_take": (T.LongType(), lambda r: want(r) - r["_rank_before"]),
                "_whole": (T.BooleanType(), lambda r: want(r) - r["_rank_before"] >= r["_rows"]),
            },
            keep=lambda r: want(r) > r["_rank_before"],
        )
        cut = out.filter(~F.col("_whole")).withColumn("_rn", F.row_number().over(self._local()))
        parts = out.filter("_whole").unionByName(cut.filter("_rn <= _take").drop("_rn"))
        return parts.drop(_BUCKET, "_take", "_whole")

    def mark(self, df: DataFrame, sizes: int | dict[tuple, int], name: str) -> DataFrame:
        """All rows with a flag on the first ``sizes`` in order (per group)."""

        def take(r: dict) -> int:
            want = sizes.get(tuple(r[g] for g in self.within), 0) if isinstance(sizes, dict) else sizes
            return max(0, min(r["_rows"], want - r["_rank_before"]))

        out = self._attach(
            df,
            {
                "_take": (T.LongType(), take),
                "_cut": (T.BooleanType(), lambda r: 0 < take(r) < r["_rows"]),
            },
        )
        whole = out.filter("not _cut").withColumn(name, F.col("_take") > 0)
        rank = F.row_number().over(self._local())
        cut = out.filter("_cut").withColumn(name, rank <= F.col("_take"))
        return whole.unionByName(cut).drop(_BUCKET, "_take", "_cut")

    def slice(self, df: DataFrame, first: int, last: int) -> DataFrame:
        """Rows with ``first < rank <= last``; no other buckets are read into the sort."""
        out = self._attach(
            df,
            {"_rank_before": (T.LongType(), lambda r: r["_rank_before"])},
            keep=lambda r: r["_rank_before"] < last and r["_rank_before"] + r["_rows"] > first,
        )
        rank = F.row_number().over(self._local()) + F.col("_rank_before")
        out = out.withColumn("_rank", rank).filter(F.col("_rank").between(first + 1, last))
        return out.drop(_BUCKET, "_rank_before", "_rank")

    def bins(
        self, df: DataFrame, n_bins: int, name: str = "bin", total: float | None = None
    ) -> DataFrame:
        """Every row with its equal-width bin of the running weight (1..n_bins).

        ``total`` ends the scale early, for rows (nulls) that sort behind the ranked ones.
        """
        scale = self._scale(df, n_bins, total)
        out = self._cut(df, scale)
        return self._binned(out, scale, name).unionByName(
            out.filter("_first = _last").withColumn(name, F.col("_first"))
        ).drop(_BUCKET, "_before", "_first", "_last")

    # -- aggregated results ----------------------------------------------------

    def summarize(
        self,
        df: DataFrame,
        n_bins: int,
        measures: Sequence[Measure],
        name: str = "bin",
        total: float | None = None,
    ) -> DataFrame:
        """Measures per equal-width bin of the running weight.

        Buckets inside one bin come from the fitted totals; only rows of buckets cut by a
        bin edge are read again. ``fit`` must have been given the same measures.
        """
        scale = self._scale(df, n_bins, total)
        types = {m.name: m.over_rows() for m in measures}
        cut = self._cut(df, scale, only_cut=True)
        fresh = self._binned(cut, scale, name).groupBy(name).agg(*types.values())
        schema = T.StructType(
            [T.StructField(name, T.IntegerType())] + [fresh.schema[m.name] for m in measures]
        )
        stored = df.sparkSession.createDataFrame(
            [
                (a, *[r[m.name] for m in measures])
                for r in self.totals
                for a, b in [scale.span(r)]
                if a == b
            ],
            schema,
        )
        return (
            stored.unionByName(fresh).groupBy(name).agg(*[m.over_parts() for m in measures])
        )

    def _scale(self, df: DataFrame, n_bins: int, total: float | None = None) -> _Scale:
        if self.within:
            raise ValueError("bins are defined for one order, not per group")
        if not self.totals:
            return _Scale(0, 0, n_bins)
        low = 1
        if self.weight:
            # One row per task survives this: Spark keeps the best row, it does not sort.
            low = df.orderBy(*self.sort_columns()).select(self.weight).first()[0]
        return _Scale(low, self.total() if total is None else total, n_bins)

    def _cut(self, df: DataFrame, scale: _Scale, only_cut: bool = False) -> DataFrame:
        t = self._number_type()

        def crossed(r: dict) -> bool:
            a, b = scale.span(r)
            return a != b

        return self._attach(
            df,
            {
                "_before": (t, lambda r: _as(t, r["_before"])),
                "_first": (T.IntegerType(), lambda r: scale.span(r)[0]),
                "_last": (T.IntegerType(), lambda r: scale.span(r)[1]),
            },
            keep=crossed if only_cut else None,
        )

    def _binned(self, out: DataFrame, scale: _Scale, name: str) -> DataFrame:
        value = F.col(self.weight) if self.weight else F.lit(1)
        frame = self._local().rowsBetween(Window.unboundedPreceding, Window.currentRow)
        running = F.sum(value).over(frame) + F.col("_before")
        return out.filter("_first <> _last").withColumn(name, scale.column(running))


@dataclass(frozen=True)
class _Scale:
    """Equal-width bins over a running weight between ``low`` and ``high``."""

    low: float
    high: float
    n: int

    def of(self, running) -> int:
        if self.high <= self.low:
            return 1
        return max(1, math.ceil(self.n * float(running - self.low) / float(self.high - self.low)))

    def span(self, r: dict) -> tuple[int, int]:
        return self.of(r["_before"]), self.of(r["_before"] + (r["_weight"] or 0))

    def column(self, running: Column) -> Column:
        if self.high <= self.low:
            return F.lit(1)
        share = (running - F.lit(self.low)).cast("double") * self.n / float(self.high - self.low)
        return F.greatest(F.lit(1), F.ceil(share).cast("int"))


def _as(t: T.DataType, value):
    return float(value) if isinstance(t, T.DoubleType) else int(value)


def _bucketed_values(
    df: DataFrame, cols: Sequence[str], buckets: int, keep: Sequence[str] = ()
) -> tuple[DataFrame, list[Splits], dict[int, dict[int, int]]]:
    """Values of several columns as rows (column no. ``i``, bucket ``b``, value ``v``),
    with the edges and the row count of every bucket."""
    none = F.lit(None).cast("double")
    values = df.select(
        *keep,
        *[F.nanvl(F.col(c).cast("double"), none).alias(f"_v{i}") for i, c in enumerate(cols)],
    )
    splits = quantile_splits(values, [F.col(f"_v{i}") for i in range(len(cols))], buckets)
    marked = Bucketizer(
        splitsArray=[list(s.points) for s in splits],
        inputCols=[f"_v{i}" for i in range(len(cols))],
        outputCols=[f"_b{i}" for i in range(len(cols))],
        handleInvalid="keep",
    ).transform(values)
    one = [
        F.struct(
            F.lit(i).alias("i"),
            F.col(f"_b{i}").cast("int").alias("b"),
            F.col(f"_v{i}").alias("v"),
        )
        for i in range(len(cols))
    ]
    long = marked.select(*keep, F.inline(F.array(*one))).filter("v is not null")
    counts: dict[int, dict[int, int]] = {i: {} for i in range(len(cols))}
    for r in long.groupBy("i", "b").count().collect():  # bounded by columns x buckets
        counts[r["i"]][r["b"]] = r["count"]
    return long, splits, counts


def average_ranks(
    df: DataFrame, cols: Sequence[str], key: str, buckets: int | None = None
) -> DataFrame:
    """The average rank of every value in its column (ties share it), one row per key.

    Values that fill a bucket of their own have a rank that follows from the counts, so
    heavy ties are never gathered; other values are ranked inside their bucket. Buckets and
    tasks grow in number with the rows, so that what a task sorts or groups does not.
    """
    buckets = buckets or max(default_buckets(df), -(-df.count() // RANK_ROWS))
    long, splits, counts = _bucketed_values(df, cols, buckets, keep=[key])
    tasks = max(1, -(-sum(sum(sizes.values()) for sizes in counts.values()) // RANK_ROWS))
    facts = []
    for i, sizes in counts.items():
        before = 0
        for b in sorted(sizes):
            tied = (sizes[b] + 1) / 2 if b in splits[i].heavy else None
            facts.append((i, b, before, tied))
            before += sizes[b]
    known = df.sparkSession.createDataFrame(facts, "i int, b int, before long, tied double")
    if len(facts) <= SMALL_TABLE_ROWS:
        known = F.broadcast(known)
    long = long.join(known, ["i", "b"])
    local = Window.partitionBy("i", "b").orderBy("v")
    ties = F.count(F.lit(1)).over(local.rangeBetween(Window.currentRow, Window.currentRow))
    loose = long.filter("tied is null").repartition(tasks, "i", "b")
    ranked = loose.withColumn("tied", F.rank().over(local) + (ties - 1) / 2)
    ranks = long.filter("tied is not null").unionByName(ranked)
    place = F.col("before") + F.col("tied")
    # Dealt by key first: the rows of a key come from different tasks, which would hold all keys in vain.
    return ranks.repartition(tasks, key).groupBy(key).agg(
        *[F.max(F.when(F.col("i") == i, place)).alias(c) for i, c in enumerate(cols)]
    )


def exact_quantiles(
    df: DataFrame, cols: Sequence[str], probs: Sequence[float], buckets: int | None = None
) -> dict[str, list[float]]:
    """Exact quantiles with linear interpolation, for several columns at once.

    Three passes and no sort of the whole: approximate edges, counts per bucket, then the
    values of just the buckets that hold a wanted rank, counted before they are shuffled.
    Columns without values give an empty list.
    """
    buckets = buckets or default_buckets(df)
    cols = list(cols)
    long, splits, counts = _bucketed_values(df, cols, buckets)

    found: dict[tuple[int, int], float] = {}
    wanted: list[tuple[int, int, int, int]] = []
    spots: dict[int, list[tuple[int, int, float]]] = {}
    for i in range(len(cols)):
        n = sum(counts[i].values())
        spots[i] = []
        if n == 0:
            continue
        for p in probs:
            h = p * (n - 1)
            spots[i].append((math.floor(h), math.ceil(h), h))
        ranks = sorted({x for lo, hi, _ in spots[i] for x in (lo, hi)})
        before = 0
        for b in sorted(counts[i]):
            size = counts[i][b]
            for rank in ranks:
                if before <= rank < before + size:
                    if b in splits[i].heavy:
                        found[i, rank] = splits[i].value_of(b)
                    else:
                        wanted.append((i, b, rank, rank - before))
            before += size
    if wanted:
        ranks_df = F.broadcast(  # at most two rows per column and probability
            df.sparkSession.createDataFrame(wanted, "i int, b int, rank long, local long")
        )
        pairs = [F.struct(F.lit(i), F.lit(b)) for i, b in sorted({(w[0], w[1]) for w in wanted})]
        inside = long.filter(F.struct("i", "b").isin(*pairs)).groupBy("i", "b", "v").count()
        w = Window.partitionBy("i", "b").orderBy("v")
        upto = F.sum("count").over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        hits = (
            inside.withColumn("upto", upto)
            .join(ranks_df, ["i", "b"])
            .filter("upto > local and upto - count <= local")
        )
        for r in hits.select("i", "rank", "v").collect():
            found[r["i"], r["rank"]] = r["v"]
    out: dict[str, list[float]] = {}
    for i, c in enumerate(cols):
        out[c] = [
            found[i, lo] + (found[i, hi] - found[i, lo]) * (h - lo) for lo, hi, h in spots[i]
        ]
    return out


def running_by_value(
    df: DataFrame,
    by: str,
    ascending: bool,
    sums: dict[str, Column],
    splits: Splits | None = None,
    buckets: int | None = None,
) -> tuple[DataFrame, dict]:
    """Group by a value and run its sums along the value order.

    Gives one row per distinct value with each sum and, as ``<name>_run``, its running
    total (the row itself included), and the grand totals. Bucket totals come straight
    from the rows, so only the grouped values are shuffled. ``splits`` reuses edges fitted
    for the same order.
    """
    measures = [Measure(name, "sum", expr) for name, expr in sums.items()]
    index = OrderIndex.fit(
        df, [(by, ascending)], by, measures=measures, buckets=buckets, splits=splits
    )
    grouped = df.groupBy(by).agg(*[m.over_rows() for m in measures])
    before = {name: 0 for name in sums}
    for r in index.totals:
        for name in sums:
            r[f"_pre_{name}"] = before[name]
            before[name] += r[name] or 0
    kinds = {name: grouped.schema[name].dataType for name in sums}
    index.schema = grouped.schema
    out = index._attach(
        grouped,
        {
            f"_pre_{n}": (kinds[n], lambda r, n=n: _as(kinds[n], r[f"_pre_{n}"]))
            for n in sums
        },
    )
    frame = index._local().rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = out.select(
        by,
        *sums,
        *[(F.sum(n).over(frame) + F.col(f"_pre_{n}")).alias(f"{n}_run") for n in sums],
    )
    return rows, before
