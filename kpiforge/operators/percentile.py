"""Exact grouped PERCENTILE_CONT without gathering a group in one task.

Spark's built-in ``percentile`` keeps a value->count map per group and merges
all partial maps of a group in a single task; with one group holding a third of
all rows (one state, one month) that map grows with the data. This operator
keeps every task bounded instead:

1. histogram ``H``: one row per distinct (keys, value) with its weight, built by
   an ordinary hash aggregate (map-side combine, shuffle on (keys, value), so a
   hot group is spread over all reducers); cut from its lineage once;
2. per group: n, min, max -> the two target ranks floor/ceil(p*(n-1));
3. refinement passes: values of each open target range are cut into B equal
   sub-ranges and counted per (target, bucket) - at most B rows per target -
   and the bucket holding the target rank becomes the next range;
4. once a range holds one distinct value, or at most ``finish_rows`` distinct
   values, the rank is resolved exactly with a running sum over that bounded
   slice.

When the whole histogram has at most ``finish_rows`` rows (its row count is
observed while it is written), no group can exceed the bound either: one window
per group then resolves both ranks and steps 2-4 are skipped. Other per-group
aggregates over the same histogram (``extra``) are returned beside the
percentile, in the same pass on that path.

The driver only sees row counts; every shuffle is keyed so that no task holds
more than ``finish_rows`` histogram rows of one group or B buckets of one target.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, Window
from pyspark.sql import functions as F

from kpiforge.session import cut_lineage, cut_lineage_counted

DEFAULT_BUCKETS = 1 << 16  # buckets per target per pass: one pass narrows 10^11 rows to ~10^6
DEFAULT_FINISH_ROWS = 1 << 20  # rows one task sorts to resolve a rank directly


def _ns_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null keys match each other (grouping keys may be null)."""
    ren = {k: f"__r_{i}" for i, k in enumerate(keys)}
    r = right.select(*[F.col(c).alias(ren.get(c, c)) for c in right.columns])
    cond = reduce(lambda a, b: a & b,
                  [left[k].eqNullSafe(r[ren[k]]) for k in keys]) if keys else F.lit(True)
    out = left.join(r, cond, how)
    return out.drop(*ren.values()) if how not in ("left_anti", "left_semi") else out


def _is_open(finish_rows: int):
    """A target still needs a refinement pass: its range holds more than one
    distinct value and more than ``finish_rows`` histogram rows."""
    return (F.col("__pL") < F.col("__pU")) & (F.col("__pd") > finish_rows)


# a target table (two rows per group) of up to this counted size is broadcast;
# a larger one is joined by shuffle
SMALL_TARGETS = 100_000


def _cut_counting_open(targets: DataFrame, finish_rows: int) -> tuple[DataFrame, int]:
    """Checkpoint the target table, counting its rows and its open targets in
    the same job through observed metrics; broadcast it if it is small."""
    obs = Observation()
    out = cut_lineage(targets.observe(obs, F.count_if(_is_open(finish_rows)).alias("open"),
                                      F.count(F.lit(1)).alias("rows")))
    got = obs.get
    return F.broadcast(out) if got["rows"] <= SMALL_TARGETS else out, int(got["open"] or 0)


def percentile_from_histogram(hist: DataFrame, keys: list[str], value: str, weight: str,
                              p: float, out: str, buckets: int | None = None,
                              finish_rows: int | None = None,
                              max_passes: int = 200, hist_rows: int | None = None,
                              extra: list | tuple = ()) -> DataFrame:
    """PERCENTILE_CONT(p) per group from a weighted histogram.

    ``hist`` has columns ``keys + [value, weight]`` (and any others ``extra``
    reads): value cast to double, rows with a null value are ignored by the
    percentile (a group of nulls only has a null percentile), weight a positive
    count. Duplicate (keys, value) rows are allowed, so plain rows of weight 1
    serve too. ``extra`` are further aggregate columns over the histogram rows,
    returned per group beside the percentile (computed in the same pass when
    the histogram is small).
    It should be cheap to re-read (checkpointed or a table): it is scanned once
    per pass. Returns ``keys + [out]`` with one row per group present in hist.
    ``hist_rows`` (the histogram's row count, if known) at most ``finish_rows``
    means no group can need a refinement pass: one window per group then
    resolves both ranks.
    """
    if not 0.0 <= p <= 1.0:
        raise ValueError("p must be in [0, 1]")
    buckets = buckets or DEFAULT_BUCKETS
    finish_rows = finish_rows or DEFAULT_FINISH_ROWS
    ks = list(keys)
    if hist_rows is not None and hist_rows <= finish_rows:
        return _small_histogram(hist, ks, value, weight, p, out, extra)
    v = F.col(value).cast("double")
    w_ = F.when(v.isNotNull(), F.col(weight).cast("long"))
    # totals and ``extra`` in one scan; groups without a value keep their row
    groups = cut_lineage(hist.groupBy(*ks).agg(
        F.sum(w_).alias("__pn"), F.min(v).alias("__plo"), F.max(v).alias("__phi"), F.count(w_).alias("__pd"), *extra))
    h = (hist.where(v.isNotNull())
         .select(*keys, v.alias("__pv"), F.col(weight).cast("long").alias("__pw")))
    tot = groups.where(F.col("__pn") > 0)
    pos = F.lit(float(p)) * (F.col("__pn") - 1).cast("double")
    tot = tot.select(*ks, "__plo", "__phi", "__pd",
                     F.floor(pos).cast("long").alias("__pr0"),
                     F.ceil(pos).cast("long").alias("__pr1"),
                     (pos - F.floor(pos)).alias("__pfrac"))
    targets = (tot.select(
        *ks, "__pfrac",
        F.explode(F.array(
            F.struct(F.lit(0).alias("__pside"), F.col("__pr0").alias("__pr")),
            F.struct(F.lit(1).alias("__pside"), F.col("__pr1").alias("__pr")))).alias("__pt"),
        F.col("__plo").alias("__pL"), F.col("__phi").alias("__pU"), F.col("__pd").alias("__pd"))
        .select(*ks, "__pfrac", "__pt.__pside", "__pt.__pr", "__pL", "__pU", "__pd"))
    targets, n_open = _cut_counting_open(targets, finish_rows)

    tk = ks + ["__pside"]
    for _ in range(max_passes):
        if n_open == 0:
            break
        open_ = targets.where(_is_open(finish_rows))
        cand = (_ns_join(h, open_.select(*tk, "__pr", "__pL", "__pU"), ks)
                .where(F.col("__pv").between(F.col("__pL"), F.col("__pU"))))
        b = F.least(F.floor((F.col("__pv") - F.col("__pL")) / (F.col("__pU") - F.col("__pL")) * buckets),
                    F.lit(buckets - 1)).cast("int")
        hb = (cand.groupBy(*tk, "__pr", b.alias("__pb"))
              .agg(F.sum("__pw").alias("__pcnt"), F.count(F.lit(1)).alias("__pd"),
                   F.min("__pv").alias("__pbl"), F.max("__pv").alias("__pbu")))
        w = Window.partitionBy(*tk).orderBy("__pb").rowsBetween(Window.unboundedPreceding, -1)
        hb = hb.withColumn("__pbefore", F.coalesce(F.sum("__pcnt").over(w), F.lit(0)))
        chosen = (hb.where((F.col("__pbefore") <= F.col("__pr")) & (F.col("__pr") < F.col("__pbefore") + F.col("__pcnt")))
                  .select(*tk, (F.col("__pr") - F.col("__pbefore")).alias("__pr"),
                          F.col("__pbl").alias("__pL"), F.col("__pbu").alias("__pU"), "__pd"))
        chosen = _ns_join(chosen, targets.select(*tk, "__pfrac"), tk)
        kept = _ns_join(targets, open_.select(*tk), tk, "left_anti")
        targets, n_open = _cut_counting_open(kept.unionByName(chosen.select(*targets.columns)),
                                             finish_rows)
    else:
        raise RuntimeError("percentile refinement did not converge")

    solved = targets.where(F.col("__pL") == F.col("__pU")).select(*tk, "__pfrac", F.col("__pL").alias("__pval"))
    rest = targets.where(F.col("__pL") < F.col("__pU"))
    slice_ = (_ns_join(h, rest.select(*tk, "__pr", "__pL", "__pU"), ks)
              .where(F.col("__pv").between(F.col("__pL"), F.col("__pU"))))
    w = (Window.partitionBy(*tk).orderBy("__pv")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    picked = (slice_.withColumn("__pcum", F.sum("__pw").over(w))
              .where((F.col("__pcum") - F.col("__pw") <= F.col("__pr")) & (F.col("__pr") < F.col("__pcum")))
              .select(*tk, F.col("__pv").alias("__pval")))
    picked = _ns_join(picked, rest.select(*tk, "__pfrac"), tk)
    sides = solved.unionByName(picked.select(*solved.columns))
    res = sides.groupBy(*ks).agg(
        F.max(F.when(F.col("__pside") == 0, F.col("__pval"))).alias("__pa"),
        F.max(F.when(F.col("__pside") == 1, F.col("__pval"))).alias("__pb"),
        F.max("__pfrac").alias("__pfrac"))
    res = res.select(*ks, (F.col("__pa") + (F.col("__pb") - F.col("__pa")) * F.col("__pfrac")).alias(out))
    res = _ns_join(groups, res, ks, "left")
    return res.select(*ks, out, *[c for c in groups.columns if c not in ks and not c.startswith("__p")])


def _small_histogram(hist: DataFrame, ks: list[str], value: str, weight: str, p: float,
                     out: str, extra) -> DataFrame:
    """Whole histogram within ``finish_rows``: every group is too, so one
    window per group (running weight and group total, null values weighing 0)
    finds both ranks; the fold that follows reuses the window's partitioning
    and also evaluates the ``extra`` aggregates."""
    v = F.col(value).cast("double")
    x = hist.withColumn("__pv", v).withColumn(
        "__pw", F.when(v.isNotNull(), F.col(weight).cast("long")).otherwise(F.lit(0)))
    grp = Window.partitionBy(*ks)
    run = grp.orderBy("__pv").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    x = (x.withColumn("__pn", F.sum("__pw").over(grp))
         .withColumn("__pcum", F.sum("__pw").over(run)))
    pos = F.lit(float(p)) * (F.col("__pn") - 1).cast("double")

    def covers(rank):
        return (F.col("__pw") > 0) & (F.col("__pcum") - F.col("__pw") <= rank) & (rank < F.col("__pcum"))

    lo, hi = F.floor(pos).cast("long"), F.ceil(pos).cast("long")
    res = x.groupBy(*ks).agg(
        F.max(F.when(covers(lo), F.col("__pv"))).alias("__pa"),
        F.max(F.when(covers(hi), F.col("__pv"))).alias("__pb"),
        F.max(F.when(F.col("__pn") > 0, pos - F.floor(pos))).alias("__pfrac"),
        *extra)
    return res.select(*ks, (F.col("__pa") + (F.col("__pb") - F.col("__pa")) * F.col("__pfrac")).alias(out),
                      *[c for c in res.columns if c not in ks and not c.startswith("__p")])


def percentile_cont(df: DataFrame, keys: list[str], value, p: float, out: str,
                    **kwargs) -> DataFrame:
    """Exact PERCENTILE_CONT(p) WITHIN GROUP (ORDER BY value) per ``keys``,
    nulls ignored. Builds and checkpoints the value histogram first."""
    v = F.col(value) if isinstance(value, str) else value
    hist = (df.select(*keys, v.cast("double").alias("__hv")).where(F.col("__hv").isNotNull())
            .groupBy(*keys, "__hv").agg(F.count(F.lit(1)).alias("__hw")))
    hist, rows = cut_lineage_counted(hist)
    return percentile_from_histogram(hist, list(keys), "__hv", "__hw", p, out,
                                     hist_rows=rows, **kwargs)
