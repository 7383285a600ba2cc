"""Queries over evaluation scans and distributions."""

from __future__ import annotations

from pyspark.sql import functions as F

from gaitmill.operators import clean as c
from gaitmill.operators import stats as s
from gaitmill.operators.quantiles import REPORT_PERCENTILES
from gaitmill.plans.registry import REGISTRY
from gaitmill.plans.tables import (
    EVENT_KEYS,
    EVENT_ORDER,
    EVENTS_AT,
    EVENTS_RULE,
    EVENTS_SQL,
    LABELS_SQL,
    LAYOUT_SQL,
    events,
    load,
)

THRESHOLDS = (1.0, 2.0, 5.0, 10.0, 20.0, 50.0)


def _scan(spark, sf_dir):
    return s.scan_recordings(
        events(spark, sf_dir),
        EVENTS_AT,
        thresholds=THRESHOLDS,
        stuck_dt=EVENTS_RULE.stuck_dt,
        small_gap_dt=EVENTS_RULE.small_gap_dt,
        big_gap_dt=EVENTS_RULE.big_gap_dt,
        units_per_metre=EVENTS_RULE.units_per_metre,
    )


SCAN_SQL = LABELS_SQL + """,
scan AS (
  SELECT category, recording_id, COUNT(*) AS n, COALESCE(SUM(dt), 0.0) AS dur,
         COALESCE(MAX(sp), 0.0) AS max_speed, COALESCE(median(dt), 0.0) AS med_dt,
         COALESCE(MAX(dt), 0.0) AS max_dt,
         COUNT(*) FILTER (WHERE dt < 2000) AS n_stuck,
         COUNT(*) FILTER (WHERE dt > 50000 AND dt <= 110000) AS n_gap_small,
         COUNT(*) FILTER (WHERE dt > 110000) AS n_gap_big
  FROM speed GROUP BY ALL)"""


@REGISTRY.add(
    SCAN_SQL
    + """ SELECT category, recording_id, n, round(dur, 6) AS dur, max_speed,
  round(med_dt, 7) AS med_dt, max_dt, n_stuck, n_gap_small, n_gap_big FROM scan"""
)
def recording_scan(spark, sf_dir):
    rounded = {"dur": F.round("dur", 6), "med_dt": F.round("med_dt", 7)}
    return _scan(spark, sf_dir).withColumns(rounded).drop("hits")


@REGISTRY.add(
    LABELS_SQL
    + """, th AS (SELECT UNNEST([1.0, 2.0, 5.0, 10.0, 20.0, 50.0]) AS x)
  SELECT category, CAST(x AS DOUBLE) AS threshold, COUNT(*) FILTER (WHERE sp > x) AS frames_hit
  FROM speed, th GROUP BY ALL"""
)
def speed_thresholds(spark, sf_dir):
    return s.threshold_hits(_scan(spark, sf_dir), THRESHOLDS, by=["category"])


@REGISTRY.add(
    SCAN_SQL
    + """ SELECT category, COUNT(*) AS files, CAST(SUM(n) AS BIGINT) AS frames,
  round(SUM(dur), 4) AS dur, MAX(max_speed) AS max_speed, MAX(max_dt) AS max_dt,
  CAST(SUM(n_stuck) AS BIGINT) AS n_stuck, CAST(SUM(n_gap_small) AS BIGINT) AS n_gap_small,
  CAST(SUM(n_gap_big) AS BIGINT) AS n_gap_big FROM scan GROUP BY ROLLUP (category)"""
)
def category_rollup(spark, sf_dir):
    return s.category_scan(_scan(spark, sf_dir)).withColumn("dur", F.round("dur", 4))


@REGISTRY.add(
    SCAN_SQL
    + """ SELECT COUNT(*) AS total_files, CAST(SUM(n) AS BIGINT) AS total_frames,
  round(SUM(dur) / 3600.0, 6) AS total_dur_h, MAX(max_speed) AS global_max_speed,
  MAX(max_dt) AS max_dt_global, CAST(SUM(n_stuck) AS BIGINT) AS n_stuck,
  CAST(SUM(n_gap_small) AS BIGINT) AS n_gap_small, CAST(SUM(n_gap_big) AS BIGINT) AS n_gap_big,
  round(median(med_dt), 5) AS median_of_med_dt, round(median(max_dt), 5) AS median_of_max_dt
  FROM scan"""
)
def median_of_medians(spark, sf_dir):
    places = {"total_dur_h": 6, "median_of_med_dt": 5, "median_of_max_dt": 5}
    summary = s.scan_summary(_scan(spark, sf_dir))
    return summary.withColumns({c: F.round(c, p) for c, p in places.items()})


@REGISTRY.add(
    LAYOUT_SQL
    + """ SELECT seg_id, arg_max(t, frame_idx) - arg_min(t, frame_idx) AS duration
  FROM cleaned GROUP BY ALL"""
)
def segment_durations(spark, sf_dir):
    rows = events(spark, sf_dir)
    filled = c.cleaned_frames(rows, c.clean(rows, EVENTS_AT, EVENTS_RULE, settled=True), EVENTS_AT, values=["value"])
    return s.segment_durations(filled, ["seg_id"], "frame_idx")


# -- distributions -------------------------------------------------------------

ORDER_SECONDS = "o_totalprice / 300.0"


def _order_durations(spark, sf_dir):
    seconds = F.col("o_totalprice") / 300.0
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderstatus").alias("category"), seconds.alias("duration_s")
    )


QUANTILES = ", ".join(str(p / 100.0) for p in REPORT_PERCENTILES)
PERCENTILE_LIST = ", ".join(f"{p}.0" for p in REPORT_PERCENTILES)


@REGISTRY.add(
    f"""SELECT CAST(percentile AS DOUBLE) AS percentile, round(value, 6) AS value FROM (
  SELECT UNNEST([{PERCENTILE_LIST}]) AS percentile,
         UNNEST(quantile_cont(l_extendedprice, [{QUANTILES}])) AS value FROM lineitem)"""
)
def duration_percentiles(spark, sf_dir):
    found = s.duration_percentiles(load(spark, sf_dir, "lineitem"), "l_extendedprice")
    return found.withColumn("value", F.round("value", 6))


@REGISTRY.add(
    f"""SELECT category, CAST(percentile AS DOUBLE) AS percentile, round(value, 6) AS value FROM (
  SELECT l_returnflag AS category, UNNEST([{PERCENTILE_LIST}]) AS percentile,
         UNNEST(quantile_cont(l_extendedprice, [{QUANTILES}])) AS value
  FROM lineitem GROUP BY l_returnflag)"""
)
def category_percentiles(spark, sf_dir):
    rows = load(spark, sf_dir, "lineitem").withColumnRenamed("l_returnflag", "category")
    found = s.duration_percentiles(rows, "l_extendedprice", ["category"])
    return found.withColumn("value", F.round("value", 6))


def _bins_sql(edges, labels) -> str:
    rows = []
    for i, (lo, hi, label) in enumerate(zip(edges[:-1], edges[1:], labels)):
        rows.append(f"({i}, {float(lo)}, {'1e300' if hi == float('inf') else float(hi)}, '{label}')")
    return "bins(bin_no, lo, hi, bin) AS (VALUES " + ", ".join(rows) + ")"


def _histogram_sql(edges, labels) -> str:
    return f"""WITH {_bins_sql(edges, labels)},
o AS (SELECT o_orderstatus AS category, {ORDER_SECONDS} AS v FROM orders),
n AS (SELECT category, COUNT(*) AS n FROM o GROUP BY ALL),
h AS (SELECT category, bin_no, COUNT(*) AS c FROM o JOIN bins ON v >= lo AND v < hi GROUP BY ALL)
SELECT n.category, CAST(b.bin_no AS INTEGER) AS bin_no, b.bin, COALESCE(h.c, 0) AS count,
  100.0 * COALESCE(h.c, 0) / n.n AS percent
FROM n CROSS JOIN bins b LEFT JOIN h ON h.category = n.category AND h.bin_no = b.bin_no"""


@REGISTRY.add(_histogram_sql(s.DURATION_EDGES, s.edge_labels(s.DURATION_EDGES)))
def duration_histogram(spark, sf_dir):
    return s.histogram(_order_durations(spark, sf_dir), "duration_s", by=["category"])


@REGISTRY.add(_histogram_sql(s.RETAINED_EDGES, s.edge_labels(s.RETAINED_EDGES, "{0:g}+")))
def retained_histogram(spark, sf_dir):
    return s.retained_histogram(_order_durations(spark, sf_dir), "duration_s", by=["category"])


@REGISTRY.add(
    f"""SELECT category, round(q[1], 6) AS p05, round(q[2], 6) AS p25, round(q[3], 6) AS p50,
  round(q[4], 6) AS p75, round(q[5], 6) AS p95 FROM (
  SELECT o_orderstatus AS category, quantile_cont({ORDER_SECONDS}, [0.05, 0.25, 0.5, 0.75, 0.95]) AS q
  FROM orders GROUP BY ALL)"""
)
def box_numbers(spark, sf_dir):
    found = s.box_numbers(_order_durations(spark, sf_dir), "duration_s", ["category"])
    return found.select("category", *[F.round(c, 6).alias(c) for c in found.columns[1:]])


@REGISTRY.add(
    f"""SELECT o_orderstatus AS category, COUNT(*) AS n, round(SUM({ORDER_SECONDS}) / 3600.0, 6) AS total_h,
  MIN({ORDER_SECONDS}) AS min, round(AVG({ORDER_SECONDS}), 6) AS mean,
  MAX({ORDER_SECONDS}) AS max, round(median({ORDER_SECONDS}), 6) AS median
  FROM orders GROUP BY ALL"""
)
def duration_summary(spark, sf_dir):
    found = s.duration_summary(_order_durations(spark, sf_dir), "duration_s", ["category"])
    return found.withColumns({c: F.round(c, 6) for c in ("total_h", "mean", "median")})


METRICS = ("frames", "files", "total")


@REGISTRY.add(
    LAYOUT_SQL
    + """, b AS (SELECT COUNT(*) AS frames, COUNT(DISTINCT recording_id) AS files, SUM(value) AS total FROM ev),
a AS (SELECT COUNT(*) AS frames, COUNT(DISTINCT seg_id) AS files, SUM(value) AS total FROM cleaned),
m AS (SELECT 'frames' AS metric, CAST(b.frames AS DOUBLE) AS before, CAST(a.frames AS DOUBLE) AS after FROM a, b
  UNION ALL SELECT 'files', b.files, a.files FROM a, b UNION ALL SELECT 'total', b.total, a.total FROM a, b)
SELECT metric, round(before, 4) AS before, round(after, 4) AS after, round(after - before, 4) AS delta,
  round(100.0 * (after - before) / before, 6) AS delta_percent FROM m"""
)
def before_after(spark, sf_dir):
    rows = events(spark, sf_dir)
    filled = c.cleaned_frames(rows, c.clean(rows, EVENTS_AT, EVENTS_RULE, settled=True), EVENTS_AT, values=["value"])

    def metrics(df, key, stage):
        one = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("v"))
        one = one.agg(
            F.sum("n").alias("frames"), F.count(F.lit(1)).alias("files"), F.sum("v").alias("total")
        )
        return s.long_metrics(one, stage, METRICS)

    compared = s.before_after(metrics(rows, "recording_id", "raw"), metrics(filled, "seg_id", "clean"))
    places = {"before": 4, "after": 4, "delta": 4, "delta_percent": 6}
    return compared.withColumns({n: F.round(n, p) for n, p in places.items()})


# -- attempts and totals ---------------------------------------------------------


@REGISTRY.add(
    """WITH f AS (
  SELECT conv_id, turn, role = 'user' AS flag,
         lag(role = 'user') OVER (PARTITION BY conv_id ORDER BY turn) AS was FROM conversations)
SELECT conv_id, COUNT(*) AS frames, COUNT(*) FILTER (WHERE flag) AS flag_frames,
  COUNT(*) FILTER (WHERE flag AND NOT COALESCE(was, FALSE)) AS attempts FROM f GROUP BY ALL"""
)
def attempt_runs(spark, sf_dir):
    turns = load(spark, sf_dir, "conversations")
    return s.flag_runs(turns, ["conv_id"], ["turn"], F.col("role") == "user")


@REGISTRY.add(
    "WITH " + EVENTS_SQL
    + """, f AS (
  SELECT *, event_type = 'purchase' AS flag,
         lag(event_type = 'purchase') OVER (PARTITION BY recording_id ORDER BY ts_us, event_id) AS was
  FROM ev),
r AS (
  SELECT category, recording_id, COUNT(*) AS frames, MAX(t) - MIN(t) AS duration,
         COUNT(*) FILTER (WHERE flag AND NOT COALESCE(was, FALSE)) AS attempts FROM f GROUP BY ALL)
SELECT category, COUNT(*) AS clips, CAST(SUM(frames) AS BIGINT) AS frames,
  round(SUM(duration) / 3600.0, 6) AS hours, CAST(SUM(attempts) AS BIGINT) AS attempts
FROM r GROUP BY ROLLUP (category)"""
)
def dataset_totals(spark, sf_dir):
    rows = events(spark, sf_dir)
    runs = s.flag_runs(rows, EVENT_KEYS, EVENT_ORDER, F.col("event_type") == "purchase")
    spans = s.segment_durations(
        rows.withColumn("_o", F.struct(*EVENT_ORDER)), EVENT_KEYS, "_o"
    )
    totals = s.dataset_totals(runs.join(spans, list(EVENT_KEYS)))
    return totals.withColumn("hours", F.round("hours", 6))
