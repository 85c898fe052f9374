"""Ordered-series operators: lags and leads per key, split where keys are hot.

A window partitioned by the series key alone puts a whole series into one
task; a station that holds a third of all rows would then sit in a single
task. ``per_size`` takes a sample of every key first, the rows whose hash over
key and order columns is divisible by a fixed number. Keys of up to about
``BUCKET_ROWS`` rows have too small a sample to be cut and take one plain window
per key. The others are cut into buckets at every ``SAMPLES``-th place of their
sorted sample: approximate quantiles of the whole order tuple, so a bucket
holds about ``BUCKET_ROWS`` rows also where a key's rows come in a burst, all at
one time, or without a time. Offsets that cross a border are repaired:

* plain lags/leads: in-bucket values first, then a second window over only
  the ``k`` rows at each end of every bucket (``_shift_edges``);
* ``IGNORE NULLS`` lags, whose look-back is unbounded: the last ``k``
  non-null rows before each bucket are found by a map-side top-k and copied
  into the bucket as halo rows (``_shift_halo``).

Both are exact -- the same values as one window over the whole series. Rows
with a NULL key or order value are rows like others (NULLs first).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

_BKT = "_sx_bucket"
_HOME = "_sx_home"
_RANK = "_sx_rank"
_PAY = "_sx_payload"
_EDGE = "_sx_edge"

DEFAULT_BUCKET_SECONDS = 86_400
# A key of more rows than this is cut into buckets of about as many.
BUCKET_ROWS = 1_000_000
# Sampled rows per bucket: sizes of buckets differ by about 1 / sqrt(SAMPLES).
SAMPLES = 64
# Borders of a key are searched in two steps of up to this many each.
BORDER_FAN = 512
# Column with the bucket of a hot key's row, for operators that work on such rows.
PART = "_sx_part"
# Session setting that overrides the default bucket width (seconds) for every
# series operator, so a cluster can size buckets to its data rate.
BUCKET_CONF = "loamline.series.bucketSeconds"


def bucket_of(df: DataFrame, order_col: str, width: float = DEFAULT_BUCKET_SECONDS) -> Column:
    """Monotone bucket id of an order column: ``width`` seconds of a timestamp,
    or ``width`` units of a number. When ``width`` is the default and the
    session sets ``loamline.series.bucketSeconds``, that value is used."""
    if width == DEFAULT_BUCKET_SECONDS:
        conf = df.sparkSession.conf.get(BUCKET_CONF, None)
        if conf:
            width = float(conf)
    dtype = df.schema[order_col].dataType
    c = F.col(order_col)
    if isinstance(dtype, T.TimestampNTZType):
        # offset from the wall-clock epoch: independent of the session time zone
        micros = F.expr(f"timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', `{order_col}`)")
        return F.floor(micros / F.lit(int(width * 1_000_000)))
    if isinstance(dtype, T.TimestampType):
        return F.floor(F.unix_micros(c) / F.lit(int(width * 1_000_000)))
    if isinstance(dtype, T.DateType):
        return F.floor(F.unix_date(c) / F.lit(max(1, int(width // 86_400))))
    return F.floor(c / F.lit(width))


def join_null_safe(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``on`` in which NULL equals NULL; the columns appear once."""
    names = {c: f"_ns_{c}" for c in on}
    right = right.withColumnsRenamed(names)
    cond = F.lit(True)
    for c, n in names.items():
        cond = cond & left[c].eqNullSafe(right[n])
    out = left.join(right, cond, how)
    return out if how in ("left_anti", "left_semi") else out.drop(*names.values())


def borders(df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket_rows: int) -> DataFrame:
    """(keys, _sx_at, _sx_no): the order tuples at which hot keys are cut, numbered
    from 1 in each key. Whether a row is sampled depends on its key and order
    columns alone, so samples of parts of the table unite to that of the whole,
    and a recomputed task draws the same rows."""
    step = max(1, bucket_rows // SAMPLES)
    each = max(1, bucket_rows // step)
    drawn = df.filter(F.pmod(F.xxhash64(*keys, *order), F.lit(step)) == 0).select(*keys, F.struct(*order).alias("_sx_at"))
    place = F.row_number().over(Window.partitionBy(*keys).orderBy("_sx_at"))
    ranked = drawn.distinct().withColumn("_sx_no", place)
    return ranked.filter(F.col("_sx_no") % each == 0).withColumn("_sx_no", (F.col("_sx_no") / each).cast("long"))


def _passed(edges: Column, at: Column) -> Column:
    """How many of the sorted ``edges`` are not after ``at`` (binary search; NULL edges: none)."""
    def halve(s, _):
        mid = F.floor((s["lo"] + s["hi"]) / 2).cast("int")
        below = (s["lo"] < s["hi"]) & (F.get(edges, mid) <= at)
        lo = F.when(below, mid + 1).otherwise(s["lo"])
        hi = F.when(below | (s["lo"] >= s["hi"]), s["hi"]).otherwise(mid)
        return F.struct(lo.alias("lo"), hi.alias("hi"))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(F.size(edges) + F.lit(1))).cast("int"))
    start = F.struct(F.lit(0).alias("lo"), F.size(edges).alias("hi"))
    return F.when(edges.isNull(), F.lit(0)).otherwise(F.aggregate(steps, start, halve, lambda s: s["lo"]))


def hot_parts(df: DataFrame, keys: Sequence[str], cuts: DataFrame, how: str = "inner") -> DataFrame:
    """Rows of the keys in ``cuts`` (``borders``) with their bucket in ``PART``,
    which grows along a key; with ``how="left"`` those of other keys, too, in
    bucket 0. Borders are found in two steps, so a row meets two short lists
    however many buckets its key has."""
    keys, cell = list(keys), F.floor(F.col("_sx_no") / BORDER_FAN)
    listed = F.sort_array(F.collect_list("_sx_at"))
    tops = cuts.filter(F.col("_sx_no") % BORDER_FAN == 0).groupBy(*keys).agg(listed.alias("_sx_tops"))
    fine = cuts.groupBy(*keys, cell.alias("_sx_cell")).agg(listed.alias("_sx_fine"))
    at = F.struct(*[F.col(f.name) for f in cuts.schema["_sx_at"].dataType])
    rows = join_null_safe(df, tops, keys, "left").withColumn("_sx_cell", _passed(F.col("_sx_tops"), at).cast("long"))
    rows = join_null_safe(rows, fine, [*keys, "_sx_cell"], how)
    part = F.col("_sx_cell") * (BORDER_FAN + 1) + _passed(F.col("_sx_fine"), at)
    return rows.withColumn(PART, part).drop("_sx_tops", "_sx_cell", "_sx_fine")


def per_size(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             each: Callable[[DataFrame, Column | None], DataFrame], *,
             bucket_rows: int | None = None) -> DataFrame:
    """``each(rows, None)`` on the rows of ordinary keys, united with
    ``each(rows, bucket)`` on those of keys with more than about ``bucket_rows``
    rows (default BUCKET_ROWS), where ``bucket`` is the column ``PART``.

    The sample is one row in ``bucket_rows / SAMPLES``; the borders, one in
    ``bucket_rows``, are joined back as adaptive execution sees fit. The list of hot
    keys, one per ``bucket_rows`` rows at most, is broadcast, so rows are dealt to
    the two branches where they are read and each is shuffled in its own only.
    Nothing runs here: without hot keys adaptive execution drops the second branch
    at run time."""
    keys, order = list(keys), list(order)
    cuts = borders(df, keys, order, bucket_rows or BUCKET_ROWS)
    hot = F.broadcast(cuts.filter("_sx_no = 1").select(*keys))
    small, large = (join_null_safe(df, hot, keys, how) for how in ("left_anti", "left_semi"))
    return each(small, None).unionByName(each(hot_parts(large, keys, cuts), F.col(PART)))


def _halo_lags(base: DataFrame, keys: list[str], order: list[str], srcs: list[str],
               depth: int, skip_nulls: bool, reverse: bool = False) -> DataFrame:
    """For each (key, bucket): the ``depth`` rows (non-null ones if
    ``skip_nulls``) that precede the bucket, labelled with that bucket
    (``reverse``: in descending order, so those that follow it)."""
    ahead, back = (F.desc, F.asc) if reverse else (F.asc, F.desc)
    src = srcs[0]
    fields = order + [c for c in srcs if c not in order]
    qual = [F.col(src).isNotNull().desc()] if skip_nulls else []
    w_top = Window.partitionBy(*keys, _BKT).orderBy(*qual, *[back(o) for o in order])
    top = (base.select(*keys, _BKT, *fields)
           .withColumn(_RANK, F.row_number().over(w_top))
           .filter(F.col(_RANK) <= depth))
    payload = F.struct(*[F.col(c) for c in fields])
    if skip_nulls:
        payload = F.when(F.col(src).isNotNull(), payload)
    w_key = Window.partitionBy(*keys).orderBy(*[ahead(o) for o in (_BKT, *order)])
    prev_bucket = F.lag(_BKT).over(w_key)
    if skip_nulls:
        earlier = [F.expr(f"lag({_PAY}, {j}) IGNORE NULLS").over(w_key) for j in range(1, depth + 1)]
    else:
        earlier = [F.lag(_PAY, j).over(w_key) for j in range(1, depth + 1)]
    halo = (top.withColumn(_PAY, payload)
            .select(*keys, _BKT,
                    (prev_bucket.isNull() | (prev_bucket != F.col(_BKT))).alias(_EDGE),
                    F.array(*earlier).alias("_sx_back"))
            .filter(F.col(_EDGE))
            .select(*keys, _BKT, F.explode(F.filter("_sx_back", lambda p: p.isNotNull())).alias(_PAY)))
    return halo.select(*keys, _BKT, *[F.col(f"{_PAY}.{c}").alias(c) for c in fields])


def shift(df: DataFrame, keys: Sequence[str], order: Sequence[str],
          lags: Mapping[str, tuple[str, int]] | None = None,
          leads: Mapping[str, tuple[str, int]] | None = None,
          *, skip_nulls: bool = False, bucket: Column | None = None,
          bucket_seconds: float | None = None, whole: bool = False,
          bucket_rows: int | None = None) -> DataFrame:
    """Add ``lag(src, k)`` / ``lead(src, k)`` columns per series.

    ``lags`` and ``leads`` map an output name to ``(source column, offset)``.
    ``order`` must be a total order within a key (add a tie-breaking id).
    ``skip_nulls`` gives ``lag(src, k) IGNORE NULLS`` (one source column, lags
    only). By default keys are treated by their size (``per_size``); ``whole``
    takes one window per key, ``bucket`` or ``bucket_seconds`` fixed buckets.
    """
    keys, order = list(keys), list(order)
    lags, leads = dict(lags or {}), dict(leads or {})
    if skip_nulls and ((lags and leads) or len({s for s, _ in (lags or leads).values()}) != 1):
        raise ValueError("skip_nulls supports lags or leads of a single source column")
    fixed = bucket_seconds is not None or df.sparkSession.conf.get(BUCKET_CONF, None)
    if whole:
        return _shift_whole(df, keys, order, lags, leads, skip_nulls)
    if bucket is None and not fixed and keys:
        out = per_size(df, keys, order, lambda rows, part: shift(
            rows, keys, order, lags, leads, skip_nulls=skip_nulls, whole=part is None, bucket=part)
            .drop(PART), bucket_rows=bucket_rows)
        return out
    seconds = bucket_seconds or DEFAULT_BUCKET_SECONDS
    if skip_nulls:
        return _shift_halo(df, keys, order, lags or leads, bucket, seconds, reverse=not lags)
    return _shift_edges(df, keys, order, lags, leads, bucket, seconds)


def _shift_whole(df, keys, order, lags, leads, skip_nulls) -> DataFrame:
    """One window per key."""
    w = Window.partitionBy(*keys).orderBy(*order)
    nulls = " IGNORE NULLS" if skip_nulls else ""
    both = [("lag", lags), ("lead", leads)]
    return df.withColumns({n: F.expr(f"{f}(`{s}`, {k}){nulls}").over(w) for f, c in both for n, (s, k) in c.items()})


def _shift_edges(df, keys, order, lags, leads, bucket, bucket_seconds) -> DataFrame:
    """Plain lags/leads in one pass over (key, bucket), then a fix-up of the
    rows near bucket edges.

    Pass A computes every offset inside the row's bucket plus the row's rank
    from both ends. Rows farther than ``m = max offset`` from both ends are
    final. The remaining edge rows (at most ``2m`` per bucket) are windowed
    again per key over edge rows only: the ``k`` rows before a start-edge row
    and after an end-edge row are themselves edge rows, so that window gives
    the exact cross-bucket values. One input scan; the full data is shuffled
    once, the edge rows once more.
    """
    max_lag = max((k for _, k in lags.values()), default=0)
    max_lead = max((k for _, k in leads.values()), default=0)
    m = max(max_lag, max_lead)
    base = df.withColumn(_BKT, bucket if bucket is not None else bucket_of(df, order[0], bucket_seconds))
    w = Window.partitionBy(*keys, _BKT).orderBy(*order)
    w_all = Window.partitionBy(*keys, _BKT)
    inner = {n: F.lag(s, k).over(w) for n, (s, k) in lags.items()}
    inner.update({n: F.lead(s, k).over(w) for n, (s, k) in leads.items()})
    inner[_RANK] = F.row_number().over(w)
    inner["_sx_rdesc"] = F.count(F.lit(1)).over(w_all) - F.row_number().over(w) + F.lit(1)
    a = base.withColumns(inner)
    is_edge = (F.col(_RANK) <= m) | (F.col("_sx_rdesc") <= m)
    interior = a.filter(~is_edge)
    w_edge = Window.partitionBy(*keys).orderBy(_BKT, *order)
    fixed = {}
    for n, (s, k) in lags.items():
        fixed[n] = F.when(F.col(_RANK) <= max_lag, F.lag(s, k).over(w_edge)).otherwise(F.col(n))
    for n, (s, k) in leads.items():
        fixed[n] = F.when(F.col("_sx_rdesc") <= max_lead, F.lead(s, k).over(w_edge)).otherwise(F.col(n))
    edges = a.filter(is_edge).withColumns(fixed)
    return interior.unionByName(edges).drop(_BKT, _RANK, "_sx_rdesc")


def _shift_halo(df, keys, order, lags, bucket, bucket_seconds, reverse=False) -> DataFrame:
    """``lag(src, k) IGNORE NULLS`` (``reverse``: ``lead``) via halo rows: the last ``k`` non-null
    rows before each bucket are found by a map-side top-k per bucket and a
    small window over those top-k rows, then copied into the bucket."""
    srcs = sorted({s for s, _ in lags.values()})
    base = df.withColumn(_BKT, bucket if bucket is not None else bucket_of(df, order[0], bucket_seconds))
    max_lag = max(k for _, k in lags.values())
    halo = _halo_lags(base, keys, order, srcs, max_lag, True, reverse).withColumn(_HOME, F.lit(False))
    rows = base.withColumn(_HOME, F.lit(True)).unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(*keys, _BKT).orderBy(*[F.desc(o) if reverse else F.asc(o) for o in order])
    new_cols = {name: F.expr(f"lag(`{src}`, {k}) IGNORE NULLS").over(w) for name, (src, k) in lags.items()}
    return rows.withColumns(new_cols).filter(F.col(_HOME)).drop(_BKT, _HOME)


def prefix_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column | str,
               name: str, *, inclusive: bool = True, total: str | None = None,
               bucket: Column | None = None, bucket_seconds: float | None = None,
               bucket_rows: int | None = None, whole: bool = False) -> DataFrame:
    """Running sum of ``value`` along each series (and, with ``total``, the
    series sum), without one task per hot key.

    Ordinary keys take one window. For hot keys ``value`` is summed per (key,
    bucket) (partial aggregation); a window over that small table turns the
    sums into bucket offsets and series totals; the table is joined back on
    (key, bucket) -- never on the key alone, NULLs equal to NULLs -- and each
    row adds its running sum inside the bucket. ``whole`` and ``bucket`` say how
    rows that ``per_size`` has dealt already are treated.
    """
    keys, order = list(keys), list(order)
    val = F.col(value) if isinstance(value, str) else value
    frame = (Window.unboundedPreceding, Window.currentRow if inclusive else -1)
    fixed = bucket_seconds is not None or df.sparkSession.conf.get(BUCKET_CONF, None)

    def plain(rows):
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame)
        cols = {name: F.coalesce(F.sum(val).over(w), F.lit(0))}
        if total:
            cols[total] = F.sum(val).over(Window.partitionBy(*keys))
        return rows.withColumns(cols)

    def bucketed(rows, by):
        base = rows.withColumn("_sx_v", val).withColumn(_BKT, by)
        sums = base.groupBy(*keys, _BKT).agg(F.sum("_sx_v").alias("_sx_s"))
        w_off = Window.partitionBy(*keys).orderBy(_BKT).rowsBetween(Window.unboundedPreceding, -1)
        cols = [*keys, _BKT, F.coalesce(F.sum("_sx_s").over(w_off), F.lit(0)).alias("_sx_off")]
        if total:
            cols.append(F.sum("_sx_s").over(Window.partitionBy(*keys)).alias(total))
        pos = join_null_safe(base, sums.select(*cols), [*keys, _BKT])
        w_in = Window.partitionBy(*keys, _BKT).orderBy(*order).rowsBetween(*frame)
        running = F.col("_sx_off") + F.coalesce(F.sum("_sx_v").over(w_in), F.lit(0))
        return pos.withColumn(name, running).drop(_BKT, "_sx_off", "_sx_v")

    if whole:
        return plain(df)
    if bucket is None and not fixed and keys:
        return per_size(df, keys, order, lambda rows, part: plain(rows) if part is None
                        else bucketed(rows, part).drop(PART), bucket_rows=bucket_rows)
    if bucket is None:
        bucket = bucket_of(df, order[0], bucket_seconds or DEFAULT_BUCKET_SECONDS)
    return bucketed(df, bucket)


def prefix_sums(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Mapping[str, str], *,
                totals: Mapping[str, str] | None = None, bucket_rows: int | None = None) -> DataFrame:
    """Several running sums (name -> column) and totals (name -> column) along
    each series in one pass, keys treated by their size."""
    keys, order, totals = list(keys), list(order), dict(totals or {})
    frame = (Window.unboundedPreceding, Window.currentRow)

    def sums(rows, part):
        if part is None:
            running, whole = Window.partitionBy(*keys).orderBy(*order).rowsBetween(*frame), Window.partitionBy(*keys)
            return rows.withColumns({n: F.sum(c).over(running) for n, c in values.items()}
                                    | {n: F.sum(c).over(whole) for n, c in totals.items()})
        each = rows.groupBy(*keys, PART).agg(*(F.sum(c).alias(f"_sx_s_{c}") for c in {*values.values(), *totals.values()}))
        before = Window.partitionBy(*keys).orderBy(PART).rowsBetween(Window.unboundedPreceding, -1)
        offsets = each.select(
            *keys, PART, *(F.coalesce(F.sum(f"_sx_s_{c}").over(before), F.lit(0)).alias(f"_sx_o_{n}") for n, c in values.items()),
            *(F.sum(f"_sx_s_{c}").over(Window.partitionBy(*keys)).alias(n) for n, c in totals.items()))
        inside = Window.partitionBy(*keys, PART).orderBy(*order).rowsBetween(*frame)
        out = join_null_safe(rows, offsets, [*keys, PART])
        out = out.withColumns({n: F.col(f"_sx_o_{n}") + F.sum(c).over(inside) for n, c in values.items()})
        return out.drop(PART, *(f"_sx_o_{n}" for n in values))

    return per_size(df, keys, order, sums, bucket_rows=bucket_rows)


def row_ids(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "row_id",
            *, total: str | None = None, bucket: Column | None = None,
            bucket_seconds: float | None = None, bucket_rows: int | None = None, whole: bool = False) -> DataFrame:
    """1-based position of each row in its series (and, with ``total``, the
    series length): a ``prefix_sum`` of 1."""
    return prefix_sum(df, keys, order, F.lit(1).cast("long"), name, total=total, bucket=bucket,
                      bucket_seconds=bucket_seconds, bucket_rows=bucket_rows, whole=whole)


def last_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
           name: str | None = None) -> DataFrame:
    """The last ``n`` rows of each key. ``row_number`` with a limit filter is
    planned as a partial and a final ``WindowGroupLimit``, so each map task
    sends at most ``n`` rows per key to the shuffle."""
    w = Window.partitionBy(*keys).orderBy(*[F.col(o).desc() for o in order])
    rank = name or "_sx_rank"
    out = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
    return out if name else out.drop(rank)


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[str], n: int,
            name: str | None = None) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*[F.col(o) for o in order])
    rank = name or "_sx_rank"
    out = df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)
    return out if name else out.drop(rank)


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str],
           cols: Sequence[str]) -> DataFrame:
    """Latest row per key as one partial+final aggregation (``max_by``)."""
    ordkey = F.struct(*[F.col(o) for o in order])
    row = F.struct(*[F.col(c) for c in list(order) + [c for c in cols if c not in order]])
    return (df.groupBy(*keys).agg(F.max_by(row, ordkey).alias("_sx_last"))
            .select(*keys, "_sx_last.*"))
