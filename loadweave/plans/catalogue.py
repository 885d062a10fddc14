"""Every operator of the library as a query over the driver's tables, with its DuckDB counterpart.

Sums of doubles depend on their order in the last digits, so results are rounded half to even before they are compared.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, numeric, text
from ..operators import reconcile as rec
from ..operators import ranking, regress, relational, rollup, savings, series, stats
from ..operators import weather as wx
from ..sources import readers, schema, scratch, warehouse, writers
from . import charts, validation
from .inputs import HOURLY, PAIRS, hourly, pairs, read

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def r(c: Column | str, places: int = 6) -> Column:
    return F.bround(F.col(c) if isinstance(c, str) else c, places)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """All double columns rounded."""
    return df.select(*[r(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# Scans, projections and filters


@query("SELECT c_custkey, upper(c_mktsegment) AS segment, c_acctbal FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_name NOT IN ('NATION_1', 'NATION_2') AND c_acctbal > 0 AND lower(c_mktsegment) IN ('building', 'machinery')")
def scan_project_filter(spark, sf_dir):
    nations = read(spark, sf_dir, "nation").where(relational.not_in(F.col("n_name"), "NATION_1", "NATION_2")).select(F.col("n_nationkey").alias("c_nationkey"))
    customers = read(spark, sf_dir, "customer").where((F.col("c_acctbal") > 0) & (text.same_text(F.col("c_mktsegment"), "building") | text.same_text(F.col("c_mktsegment"), "machinery")))
    return customers.join(nations, "c_nationkey", "left_semi").select("c_custkey", F.upper("c_mktsegment").alias("segment"), "c_acctbal")


# Rollups


@query("SELECT l_returnflag, l_linestatus, round_even(sum((l_extendedprice + l_discount) * l_quantity) / 1000, 6) AS hvac_mwh, round_even(sum(l_tax * l_quantity) / 1000, 6) AS gas_mwh, round_even(sum(l_extendedprice * l_quantity), 2) AS area FROM lineitem GROUP BY ALL")
def weighted_rollup(spark, sf_dir):
    out = rollup.metadata_rollup(read(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_extendedprice", "l_discount"], ["l_tax"], area="l_extendedprice", weight="l_quantity")
    return out.withColumn("area", r("area", 2))


@query("SELECT l_returnflag, round_even(sum(l_extendedprice * l_quantity) / 1000, 6) AS hvac_mwh, round_even(sum(l_tax * l_quantity) / 1000, 6) AS gas_mwh FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL")
def weighted_rollup_applied_only(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").withColumn("applicability", F.col("l_linestatus") == "F")
    out = rollup.metadata_rollup(items, ["l_returnflag"], ["l_extendedprice"], ["l_tax"], weight="l_quantity", applied_only=True)
    return out


@query("SELECT event_type, date_trunc('hour', ts + INTERVAL 59 MINUTE) AS ts, round_even(sum(value), 6) AS value FROM events GROUP BY ALL")
def hour_end_rollup(spark, sf_dir):
    return rounded(rollup.hourly_rollup(read(spark, sf_dir, "events"), ["event_type"], ["value"]))


@query(
    "SELECT event_type, date_trunc('hour', ts + INTERVAL 59 MINUTE) AS ts, round_even(sum(value * (1 + user_id % 7)), 6) AS value, "
    "round_even(sum(2.5 * (1 + user_id % 7)), 6) AS uses FROM events GROUP BY ALL"
)
def weighted_hour_end_rollup(spark, sf_dir):
    """Hourly totals of weighted loads: each event counts for its user's weight."""
    weighted = read(spark, sf_dir, "events").select("event_type", "ts", "value", F.lit(2.5).alias("uses"), (1.0 + F.col("user_id") % 7).alias("weight"))
    return rounded(rollup.hourly_rollup(weighted, ["event_type"], ["value", "uses"], weight="weight"))


_IN_STATES = (
    "round_even(sum(c_acctbal * (1 + c_custkey % 3)) / 1000, 6) AS hvac_mwh "
    "FROM (SELECT ['AK', 'HI', 'VT', 'CA', NULL][1 + c_nationkey % 5] AS state, c_custkey, c_mktsegment, c_acctbal FROM customer)"
)


@query(
    f"SELECT 'named' AS run, c_mktsegment, {_IN_STATES} WHERE state IN ('CA', 'VT') GROUP BY c_mktsegment "
    f"UNION ALL SELECT 'test', c_mktsegment, {_IN_STATES} WHERE state = 'VT' GROUP BY c_mktsegment "
    f"UNION ALL SELECT 'all', c_mktsegment, {_IN_STATES} WHERE state IS NULL OR state NOT IN ('AK', 'HI') GROUP BY c_mktsegment"
)
def rollup_in_scope(spark, sf_dir):
    """The metadata rollup of a run of named states, of a test run, and of a run without either; two states are in none of them."""
    state = F.element_at(F.array(*[F.lit(x) for x in ("AK", "HI", "VT", "CA", None)]), (F.col("c_nationkey") % 5 + 1).cast("int"))
    weight = (1.0 + F.col("c_custkey") % 3).alias("weight")
    buildings = read(spark, sf_dir, "customer").select(state.alias("state"), "c_mktsegment", "c_acctbal", weight, F.lit(0.0).alias("gas"))
    runs = {"named": readers.RunConfig(states=("CA", "VT", "HI")), "test": readers.RunConfig(test_mode=True), "all": readers.RunConfig()}
    totals = lambda config: rollup.metadata_rollup(config.scope(buildings), ["c_mktsegment"], ["c_acctbal"], ["gas"])
    found = [totals(config).select(F.lit(name).alias("run"), "c_mktsegment", "hvac_mwh") for name, config in runs.items()]
    return found[0].unionByName(found[1]).unionByName(found[2])


@query("SELECT event_id, make_timestamp((epoch_us(ts) * 1000) // 1000) AS stamp FROM events")
def epoch_nanos_to_ts(spark, sf_dir):
    nanos = read(spark, sf_dir, "events").select("event_id", (F.unix_micros(F.col("ts").cast("timestamp")) * 1000).alias("n"))
    return nanos.select("event_id", dates.from_epoch_nanos(F.col("n")).alias("stamp"))


@query("SELECT event_type, date_trunc('hour', ts) + INTERVAL 1 HOUR AS ts, count(*) AS n FROM events GROUP BY ALL")
def shift_hour_begin(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.groupBy("event_type", dates.hour_begin_to_end(F.date_trunc("hour", "ts").cast("timestamp_ntz")).alias("ts")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH b AS (SELECT l_suppkey, date_trunc('month', l_shipdate) AS ts, l_linenumber, sum(l_quantity) AS q FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY ALL)
SELECT x.l_suppkey, x.ts, y.l_linenumber, round_even(x.q, 4) AS q_baseline, round_even(y.q, 4) AS q_upgrade, round_even(x.q - y.q, 4) AS q_savings FROM b x JOIN b y ON x.l_suppkey = y.l_suppkey AND x.ts = y.ts AND x.l_linenumber = 1 AND y.l_linenumber = 2""")
def savings_self_join(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").where(F.col("l_linenumber").isin(1, 2)).select("l_suppkey", F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("ts"), "l_linenumber", F.col("l_quantity").alias("q"))
    return rounded(rollup.savings_rollup(items, ["l_suppkey"], "ts", "l_linenumber", ["q"], baseline=1), 4)


_UPGRADES = (1, 2)
_SAVINGS = """WITH b AS (SELECT s_suppkey AS bldg, s_nationkey AS nation, 1.0 + s_suppkey % 3 AS w, s_acctbal > 0 AS a1, s_nationkey % 2 = 0 AS a2 FROM supplier),
l AS (SELECT nation, date_trunc('month', l_shipdate) AS ts, (l_linenumber - 1) % 3 AS u, w * l_quantity AS hvac, w * l_tax AS gas, a1, a2 FROM lineitem JOIN b ON l_suppkey = bldg)
"""


def _savings_inputs(spark, sf_dir):
    """Line items as loads of buildings (suppliers) under a baseline and two upgrades, and which upgrade applies to which building."""
    loads = read(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("bldg_id"), ((F.col("l_linenumber") - 1) % 3).alias("upgrade"), F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("ts"), "l_quantity", "l_tax"
    )
    applies = F.when(F.col("upgrade") == 1, F.col("s_acctbal") > 0).when(F.col("upgrade") == 2, F.col("s_nationkey") % 2 == 0).otherwise(True)
    metadata = read(spark, sf_dir, "supplier").withColumn("upgrade", F.explode(F.array(*map(F.lit, (0, *_UPGRADES)))))
    return loads, metadata.select(F.col("s_suppkey").alias("bldg_id"), "upgrade", F.col("s_nationkey").alias("nation"), (F.lit(1.0) + F.col("s_suppkey") % 3).alias("weight"), applies.alias("applicability"))


def _wide(spark, sf_dir, upgrades, **more):
    loads, metadata = _savings_inputs(spark, sf_dir)
    measures = {"hvac": F.col("l_quantity"), "gas": F.col("l_tax")}
    return savings.wide_totals(loads, metadata, "bldg_id", "upgrade", ["nation"], measures, list(upgrades), applicable="applicability", already_hourly=True, **more)


@query(
    _SAVINGS
    + " UNION ALL ".join(
        f"SELECT nation, {u} AS upgrade, ts, round_even(sum(hvac) FILTER (u = 0), 4) AS hvac_baseline, round_even(sum(hvac) FILTER (u = {u}), 4) AS hvac_upgrade, round_even(sum(hvac) FILTER (u = 0) - sum(hvac) FILTER (u = {u}), 4) + 0.0 AS hvac_savings, "
        f"round_even(sum(gas) FILTER (u = 0), 6) AS gas_baseline, round_even(sum(gas) FILTER (u = {u}), 6) AS gas_upgrade, round_even(sum(gas) FILTER (u = 0) - sum(gas) FILTER (u = {u}), 6) + 0.0 AS gas_savings, count(*) FILTER (u = 0) AS rows_baseline, count(*) FILTER (u = {u}) AS rows_upgrade "
        f"FROM l WHERE a{u} GROUP BY nation, ts HAVING count(*) FILTER (u = 0) > 0 AND count(*) FILTER (u = {u}) > 0"
        for u in _UPGRADES
    )
)
def upgrade_savings(spark, sf_dir):
    """Savings of two upgrades, each over the buildings that it applies to, from one scan of the loads."""
    out = savings.savings(_wide(spark, sf_dir, _UPGRADES, applied_only=True), ["nation"], ["hvac", "gas"], list(_UPGRADES))
    return out.select(*[r(c, 4 if c.startswith("hvac") else 6).alias(c) if t == "double" else F.col(c) for c, t in out.dtypes])


@query(_SAVINGS + "SELECT nation, u::INTEGER AS upgrade, ts, round_even(sum(hvac), 4) AS hvac, round_even(sum(gas), 6) AS gas FROM l GROUP BY ALL")
def upgrade_totals(spark, sf_dir):
    """Totals of the baseline and of both upgrades over all buildings; groups and weights come from metadata by building."""
    out = savings.totals(_wide(spark, sf_dir, (0, *_UPGRADES)), ["nation"], ["hvac", "gas"], [0, *_UPGRADES])
    return out.select("nation", "upgrade", "ts", r("hvac", 4).alias("hvac"), r("gas").alias("gas"))


@query(_SAVINGS + "SELECT nation, u::INTEGER AS upgrade, ts, round_even(sum(hvac), 4) AS hvac FROM l GROUP BY ALL")
def upgrades_replaced(spark, sf_dir):
    """Tables by upgrade: all three are written, then one of them again, which replaces its own rows and no others."""
    path = scratch.folder(spark)
    wide = _wide(spark, sf_dir, (0, *_UPGRADES))
    of = lambda upgrades: savings.totals(wide, ["nation"], ["hvac"], upgrades).withColumn("hvac", r("hvac", 4))
    writers.replace_partitions(of([0, *_UPGRADES]), path, ["upgrade"])
    writers.replace_partitions(of([2]), path, ["upgrade"])
    return spark.read.parquet(path).select("nation", "upgrade", "ts", "hvac")


@query(f"WITH {PAIRS} SELECT n_regionkey AS zone, ts, round_even(sum(ref), 8) AS ref FROM pairs JOIN nation ON nation = n_nationkey GROUP BY ALL")
def ba_rollup(spark, sf_dir):
    to = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("zone"))
    return rounded(rollup.rolled_up(pairs(spark, sf_dir), to, "nation", "zone", "ts", "ref"), 8)


@query(f"WITH {PAIRS} SELECT coalesce(r_name, 'unmapped') AS zone, ts, round_even(sum(ref), 8) AS ref FROM pairs LEFT JOIN (SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey WHERE n_nationkey < 20) m ON nation = n_nationkey GROUP BY ALL")
def ba_rollup_with_unmapped(spark, sf_dir):
    to = read(spark, sf_dir, "nation").where("n_nationkey < 20").join(read(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("nation"), F.col("r_name").alias("zone"))
    return rounded(rollup.rolled_up(pairs(spark, sf_dir), to, "nation", "zone", "ts", "ref", unmapped="unmapped"), 8)


@query("SELECT n_regionkey, n_nationkey, ((row_number() OVER (ORDER BY n_regionkey, n_nationkey) - 1) // 7)::INTEGER AS chunk FROM nation")
def chunk_assignment(spark, sf_dir):
    return rollup.chunked(read(spark, sf_dir, "nation"), ["n_regionkey", "n_nationkey"], 7)


# Joins


@query("SELECT s_suppkey, s_nationkey, n_name FROM supplier LEFT JOIN (SELECT DISTINCT n_nationkey, n_name FROM nation) ON s_nationkey = n_nationkey")
def lookup_left_join_distinct(spark, sf_dir):
    twice = read(spark, sf_dir, "nation").withColumnRenamed("n_nationkey", "s_nationkey")
    return relational.lookup_join(read(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), twice.union(twice), ["s_nationkey"], ["n_name"])


@query("SELECT s_suppkey, v AS last_name FROM supplier LEFT JOIN (SELECT n_regionkey AS k, arg_max(n_name, n_nationkey) AS v FROM nation GROUP BY 1) ON s_suppkey % 7 = k")
def map_join_last_wins(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 7).cast("int").alias("n_regionkey"))
    return relational.last_value_join(s, read(spark, sf_dir, "nation"), "n_regionkey", "n_name", "n_nationkey").select("s_suppkey", F.col("n_name").alias("last_name"))


@query("SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def semi_join(spark, sf_dir):
    big = read(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(big, "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 300000)")
def anti_join(spark, sf_dir):
    buyers = read(spark, sf_dir, "orders").where("o_totalprice > 300000").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, sf_dir, "customer").join(buyers, "c_custkey", "left_anti").select("c_custkey", "c_name")


_DAILY = """a AS (SELECT o_orderdate::DATE AS day, sum(o_totalprice) AS v FROM orders GROUP BY 1), b AS (SELECT l_shipdate::DATE AS day, sum(l_extendedprice) AS v FROM lineitem GROUP BY 1)"""


def _daily(spark, sf_dir):
    a = read(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum("o_totalprice").alias("v"))
    return a, read(spark, sf_dir, "lineitem").groupBy(F.to_date("l_shipdate").alias("day")).agg(F.sum("l_extendedprice").alias("v"))


@query(f"WITH {_DAILY} SELECT day::VARCHAR AS day, round_even(a.v, 2) AS ref, round_even(b.v, 2) AS reg FROM a FULL JOIN b USING (day)")
def full_outer_align(spark, sf_dir):
    a, b = _daily(spark, sf_dir)
    return rounded(a.withColumnRenamed("v", "ref").join(b.withColumnRenamed("v", "reg"), "day", "full"), 2).withColumn("day", F.col("day").cast("string"))


@query(f"WITH {_DAILY} SELECT count(*) FILTER (a.v IS NOT NULL AND b.v IS NOT NULL) AS common, count(*) FILTER (b.v IS NULL) AS ref_only, count(*) FILTER (a.v IS NULL) AS reg_only FROM a FULL JOIN b USING (day)")
def inner_align_counts(spark, sf_dir):
    return relational.alignment(*_daily(spark, sf_dir), ["day"])


@query(f"WITH {_DAILY} SELECT day::VARCHAR AS day, round_even(a.v, 2) AS ref, round_even(b.v, 2) AS reg FROM a JOIN b USING (day)")
def inner_align(spark, sf_dir):
    return rounded(relational.aligned(*_daily(spark, sf_dir), ["day"], "v"), 2).withColumn("day", F.col("day").cast("string"))


@query(f"WITH {HOURLY}, n AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY ts) AS i FROM hourly) SELECT a.kind, a.ts, b.ts AS right_ts, round_even(a.v, 6) AS v, round_even(b.v, 6) AS w FROM n a JOIN n b ON a.kind = b.kind AND b.i = a.i + 1")
def positional_zip(spark, sf_dir):
    h = hourly(spark, sf_dir).select("kind", "ts", "v")
    return rounded(series.zipped(h, h.withColumnRenamed("v", "w"), ["kind"], shift=1))


@query("SELECT o_orderkey, coalesce(n_name, 'Nation ' || c_nationkey) AS label FROM orders JOIN customer ON o_custkey = c_custkey LEFT JOIN (SELECT * FROM nation WHERE n_nationkey < 12) ON c_nationkey = n_nationkey")
def label_with_fallback(spark, sf_dir):
    orders = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("c_custkey")).join(read(spark, sf_dir, "customer").select("c_custkey", F.col("c_nationkey").alias("n_nationkey")), "c_custkey")
    named = rollup.labelled(orders, read(spark, sf_dir, "nation").where("n_nationkey < 12"), "n_nationkey", "n_name", F.concat(F.lit("Nation "), F.col("n_nationkey")))
    return named.select("o_orderkey", F.col("n_name").alias("label"))


# Series


@query(f"WITH {HOURLY}, n AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY ts) AS i FROM hourly) SELECT kind, round_even(sum(v), 6) AS v FROM n WHERE i <= 500 GROUP BY ALL")
def first_n_annual_sum(spark, sf_dir):
    return rounded(series.annual(hourly(spark, sf_dir), ["kind"], ["v"], 500))


@query(f"WITH {HOURLY}, n AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY ts) AS i, count(*) OVER (PARTITION BY kind) AS c FROM hourly) SELECT kind, ts, round_even(v, 6) AS v FROM n WHERE i > 1 AND i <= c - 24")
def drop_first_and_last(spark, sf_dir):
    return rounded(series.drop_ends(hourly(spark, sf_dir).select("kind", "ts", "v"), ["kind"], first=1, last=24))


_LAGS = {-1: "m1", 1: "1", 3: "3", 6: "6", 12: "12"}


@query(f"WITH {HOURLY} SELECT kind, ts, round_even(v, 6) AS v, " + ", ".join(f"round_even(lag(v, {k}) OVER (PARTITION BY kind ORDER BY ts), 6) AS v_lag_{n}" for k, n in _LAGS.items()) + " FROM hourly")
def lag_lead_features(spark, sf_dir):
    return rounded(series.lagged(hourly(spark, sf_dir).select("kind", "ts", "v"), ["kind"], "v", list(_LAGS)))


_FILL = "round_even(coalesce(first_value({c} IGNORE NULLS) OVER (PARTITION BY kind ORDER BY ts ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), last_value({c} IGNORE NULLS) OVER (PARTITION BY kind ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)), 6)"


@query(f"WITH {HOURLY}, g AS (SELECT kind, ts, CASE WHEN hour(ts) % 4 <> 0 THEN v END AS v FROM hourly) SELECT kind, ts, {_FILL.format(c='v')} AS v FROM g")
def bfill_ffill(spark, sf_dir):
    h = hourly(spark, sf_dir).select("kind", "ts", F.when(F.hour("ts") % 4 != 0, F.col("v")).alias("v"))
    return rounded(series.filled(h, ["kind"], ["v"]))


@query(
    f"WITH {HOURLY}, l AS (SELECT kind, ts, v AS dry_bulb, " + ", ".join(f"lag(v, {k}) OVER (PARTITION BY kind ORDER BY ts) AS dry_bulb_lag_{n}" for k, n in _LAGS.items()) + " FROM hourly) SELECT kind, ts, "
    + ", ".join(f"{_FILL.format(c=c)} AS {c}" for c in ("dry_bulb", *(f"dry_bulb_lag_{n}" for n in _LAGS.values()))) + ", hour(ts)::INTEGER AS hour, (isodow(ts) >= 6)::INTEGER AS weekend FROM l"
)
def weather_features(spark, sf_dir):
    h = hourly(spark, sf_dir).select("kind", "ts", F.col("v").alias("dry_bulb"))
    return rounded(wx.weather_features(h, ["kind"], ["dry_bulb"]))


@query("SELECT event_id, user_id, date_trunc('day', ts) AS day FROM (SELECT *, row_number() OVER (PARTITION BY user_id, date_trunc('day', ts) ORDER BY event_id DESC) AS i FROM events) WHERE i = 1")
def keep_last_dedupe(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", "user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day"))
    return relational.keep_last(e, ["user_id", "day"], "event_id")


@query(f"WITH {HOURLY} SELECT kind, ts, round_even(coalesce(lag(v) OVER (PARTITION BY kind ORDER BY ts), v), 6) AS v FROM hourly")
def edge_fill_shift(spark, sf_dir):
    return rounded(series.shifted_with_edge(hourly(spark, sf_dir).select("kind", "ts", "v"), ["kind"], "v"))


@query(f"WITH {PAIRS}, e AS (SELECT DISTINCT nation FROM pairs), s AS (SELECT nation, month(ts) AS month, sum(ref) AS ref FROM pairs GROUP BY ALL) SELECT nation, m::INTEGER AS month, round_even(coalesce(ref, 0), 8) AS ref FROM e CROSS JOIN range(1, 13) t(m) LEFT JOIN s USING (nation) WHERE s.month = m UNION ALL SELECT nation, m::INTEGER, 0.0 FROM e CROSS JOIN range(1, 13) t(m) WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.nation = e.nation AND s.month = m)")
def monthly_totals(spark, sf_dir):
    return rounded(series.by_month(pairs(spark, sf_dir), ["nation"], "ref"), 8)


@query(f"WITH {PAIRS}, e AS (SELECT DISTINCT nation FROM pairs), s AS (SELECT nation, ((month(ts) % 12) // 3)::INTEGER AS k, sum(ref) AS ref FROM pairs GROUP BY ALL) SELECT e.nation, t.k::INTEGER AS season_no, ['DJF', 'MAM', 'JJA', 'SON'][t.k + 1] AS season, round_even(coalesce(ref, 0), 8) AS ref FROM e CROSS JOIN range(0, 4) t(k) LEFT JOIN s ON s.nation = e.nation AND s.k = t.k")
def seasonal_totals(spark, sf_dir):
    return rounded(series.by_season(pairs(spark, sf_dir), ["nation"], "ref"), 8)


@query("WITH s AS (SELECT event_type AS kind, ts::DATE AS day, sum(value) AS v FROM events GROUP BY ALL), e AS (SELECT kind, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM s GROUP BY kind) SELECT kind, day::VARCHAR AS day, round_even(coalesce(v, 0), 6) AS v FROM e LEFT JOIN s USING (kind, day)")
def daily_resample(spark, sf_dir):
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), "ts", F.col("value").alias("v"))
    return rounded(series.by_day(e, ["kind"], "v")).withColumn("day", F.col("day").cast("string"))


@query("WITH s AS (SELECT event_type AS kind, ts::DATE AS day, sum(value) AS v FROM events GROUP BY ALL), e AS (SELECT kind, unnest(generate_series(min(day)::TIMESTAMP, max(day)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day FROM s GROUP BY kind) SELECT kind, day::VARCHAR AS day, round_even(coalesce(v, 0), 6) AS v FROM e LEFT JOIN s USING (kind, day)")
def daily_resample_all(spark, sf_dir):
    """daily_resample over all events."""
    e = read(spark, sf_dir, "events").select(F.col("event_type").alias("kind"), "ts", F.col("value").alias("v"))
    return rounded(series.by_day(e, ["kind"], "v")).withColumn("day", F.col("day").cast("string"))


@query("SELECT event_type, unnest(generate_series(min(date_trunc('day', ts)), max(date_trunc('day', ts)), INTERVAL 1 HOUR)) AS ts FROM events GROUP BY event_type")
def hourly_calendar(spark, sf_dir):
    day = F.date_trunc("day", "ts").cast("timestamp_ntz")
    return series.hours(read(spark, sf_dir, "events").groupBy("event_type").agg(F.min(day).alias("a"), F.max(day).alias("b")), "a", "b").select("event_type", "ts")


@query("WITH b AS (SELECT DISTINCT (o_orderkey * 15)::INTEGER AS s FROM orders WHERE o_orderstatus = 'P'), n AS (SELECT s, s + 15 AS e, lead(s) OVER (ORDER BY s) AS nx FROM b) SELECT g::INTEGER AS gap_start, least(g + 15, nx)::INTEGER AS gap_end, ((nx - e) % 15 = 0) AS whole FROM (SELECT e, nx, unnest(generate_series(e, nx - 1, 15)) AS g FROM n WHERE nx > e)")
def file_gap_detection(spark, sf_dir):
    o = read(spark, sf_dir, "orders").where("o_orderstatus = 'P'").select((F.col("o_orderkey") * 15).cast("int").alias("start")).distinct()
    return series.gaps(o.withColumn("end", F.col("start") + 15), "start", "end", 15)


@query("SELECT o_orderstatus AS series, count(*) AS n, min(o_orderkey * 15) AS first_start, arg_min(o_orderkey * 15 + o_custkey, o_orderkey) AS first_end, max(o_orderkey * 15) AS last_start, arg_max(o_orderkey * 15 + o_custkey, o_orderkey) AS last_end FROM orders GROUP BY ALL")
def file_series_summary(spark, sf_dir):
    ranges = read(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("series"), (F.col("o_orderkey") * 15).alias("start"), (F.col("o_orderkey") * 15 + F.col("o_custkey")).alias("end"))
    return series.summary(ranges, "start", "end", ["series"])


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'O' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def requested_series(spark, sf_dir):
    wanted, ref, reg = (_buyers(spark, sf_dir, status) for status in "OFP")
    return relational.in_all(wanted, ["k"], ref, reg)


@query("SELECT 'run_upgrade' || (o_orderkey % 3) || '_' || lpad((o_orderkey * 15)::VARCHAR, greatest(4, length((o_orderkey * 15)::VARCHAR))::INTEGER, '0') || '-' || lpad((o_orderkey * 15 + 14)::VARCHAR, greatest(4, length((o_orderkey * 15 + 14)::VARCHAR))::INTEGER, '0') || '.csv' AS path, 'run' AS prefix, (o_orderkey % 3)::INTEGER AS upgrade, (o_orderkey * 15)::INTEGER AS start, (o_orderkey * 15 + 14)::INTEGER AS \"end\" FROM orders")
def chunk_name_parsing(spark, sf_dir):
    n = F.col("o_orderkey") * 15
    names = read(spark, sf_dir, "orders").select(F.concat(F.lit("run_upgrade"), F.col("o_orderkey") % 3, F.lit("_"), text.padded(n), F.lit("-"), text.padded(n + 14), F.lit(".csv")).alias("path"))
    return readers.parsed_chunk_names(names, "path")


# Statistics


@query(f"WITH {PAIRS}, p AS (SELECT (extract(day FROM ts) - 1) // 7 AS period, month(ts) AS hour, ref, reg FROM pairs), m AS (SELECT period, hour, avg(ref) AS a, avg(reg) AS b FROM p GROUP BY ALL) SELECT period::INTEGER AS period, round_even(corr(a, b), 6) AS correlation FROM m GROUP BY ALL")
def diurnal_corr_by_month(spark, sf_dir):
    return rounded(stats.diurnal_correlation(pairs(spark, sf_dir), F.floor((F.dayofmonth("ts") - 1) / 7).cast("int"), F.month("ts")))


@query(f"WITH {PAIRS}, d AS (SELECT ts::DATE AS day, sum(ref) AS a, sum(reg) AS b FROM pairs GROUP BY 1), s AS (SELECT unnest(generate_series((SELECT min(day) FROM d)::TIMESTAMP, (SELECT max(day) FROM d)::TIMESTAMP, INTERVAL 1 DAY))::DATE AS day), z AS (SELECT coalesce(a, 0) AS a, coalesce(b, 0) AS b FROM s LEFT JOIN d USING (day)) SELECT (SELECT round_even(corr(ref, reg), 6) FROM pairs) AS hourly, (SELECT round_even(corr(a, b), 6) FROM z) AS daily")
def hourly_and_daily_corr(spark, sf_dir):
    p = pairs(spark, sf_dir)
    a, b = stats.hourly_correlation(p).select(r("correlation").alias("hourly")), stats.daily_correlation(p).select(r("correlation").alias("daily"))
    return a.join(b, F.lit(True))  # one row each


_PCT = "n AS (SELECT nation, sum(ref) AS ref, sum(reg) AS reg FROM pairs GROUP BY ALL), d AS (SELECT *, 100 * (reg - ref) / nullif(ref, 0) AS pct_diff FROM n)"


@query(f"WITH {PAIRS}, {_PCT} SELECT nation, round_even(ref, 6) AS ref, round_even(reg, 6) AS reg, round_even(pct_diff, 6) AS pct_diff FROM d")
def county_pct_diff(spark, sf_dir):
    return rounded(stats.annual_pct_diff(pairs(spark, sf_dir), ["nation"]))


@query(f"WITH {PAIRS}, {_PCT} SELECT round_even(avg(pct_diff), 6) AS mean, round_even(median(pct_diff), 6) AS median, round_even(max(pct_diff), 6) AS max, round_even(min(pct_diff), 6) AS min, arg_max(nation, pct_diff) AS max_at, arg_min(nation, pct_diff) AS min_at FROM d")
def county_pct_diff_summary(spark, sf_dir):
    return rounded(stats.across(stats.annual_pct_diff(pairs(spark, sf_dir), ["nation"]), "pct_diff", "nation"))


@query(f"WITH {PAIRS}, {_PCT} (SELECT nation, round_even(pct_diff, 6) AS pct_diff, 'top' AS side FROM d ORDER BY d.pct_diff DESC, nation LIMIT 5) UNION ALL (SELECT nation, round_even(pct_diff, 6), 'bottom' FROM d ORDER BY d.pct_diff, nation LIMIT 5)")
def top_bottom5(spark, sf_dir):
    return rounded(relational.extremes(stats.annual_pct_diff(pairs(spark, sf_dir), ["nation"]).select("nation", "pct_diff"), "pct_diff", "nation"))


_ERRORS = "round_even(avg(abs(ref - reg)), 6) AS mae, round_even(avg(abs(ref - reg)) / nullif(avg(ref), 0), 6) AS nmae, round_even(sqrt(avg((ref - reg) * (ref - reg))), 6) AS rmse"


@query(f"WITH {PAIRS}, n AS (SELECT ts, sum(ref) AS ref, sum(reg) AS reg FROM pairs GROUP BY ALL) SELECT {_ERRORS} FROM n")
def mae_nmae_rmse_national(spark, sf_dir):
    national = pairs(spark, sf_dir).groupBy("ts").agg(F.sum("ref").alias("ref"), F.sum("reg").alias("reg"))
    return rounded(stats.errors(national, []))


@query(f"WITH {PAIRS} SELECT nation, {_ERRORS} FROM pairs GROUP BY ALL")
def mae_nmae_rmse_county(spark, sf_dir):
    return rounded(stats.errors(pairs(spark, sf_dir), ["nation"]))


@query(f"WITH {PAIRS}, z AS (SELECT n_regionkey AS zone, ts, sum(ref) AS ref, sum(reg) AS reg FROM pairs JOIN nation ON nation = n_nationkey GROUP BY ALL) SELECT zone, {_ERRORS} FROM z GROUP BY ALL")
def mae_nmae_rmse_ba(spark, sf_dir):
    zones = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_regionkey").alias("zone"))
    z = pairs(spark, sf_dir).join(zones, "nation").groupBy("zone", "ts").agg(F.sum("ref").alias("ref"), F.sum("reg").alias("reg"))
    return rounded(stats.errors(z, ["zone"]))


@query(f"WITH {PAIRS}, m AS (SELECT nation, month(ts) AS m, sum(ref) AS ref, sum(reg) AS reg FROM pairs GROUP BY ALL), x AS (SELECT abs(100 * (reg - ref) / nullif(ref, 0)) AS ape FROM m) SELECT round_even(avg(ape), 6) AS mape_mean, round_even(median(ape), 6) AS mape_median FROM x")
def entity_month_mape(spark, sf_dir):
    return rounded(stats.month_mape(pairs(spark, sf_dir), ["nation"]))


def _peak_sql(keys: str) -> str:
    first = lambda v: f"min(ts) FILTER ({v} = m{v})"
    return f"""x AS (SELECT *, max(ref) OVER (PARTITION BY {keys}) AS mref, max(reg) OVER (PARTITION BY {keys}) AS mreg FROM p),
t AS (SELECT {keys}, max(ref) AS ref_peak, max(reg) AS reg_peak, {first('ref')} AS ref_peak_at, {first('reg')} AS reg_peak_at, sum(ref) AS sref, sum(reg) AS sreg, count(*) AS c FROM x GROUP BY {keys})
SELECT t.{keys}, round_even(ref_peak, 6) AS ref_peak, round_even(reg_peak, 6) AS reg_peak, ref_peak_at, reg_peak_at, round_even(a.reg, 6) AS reg_at_ref_peak, round_even(b.ref, 6) AS ref_at_reg_peak,
round_even(100 * (reg_peak - ref_peak) / nullif(ref_peak, 0), 6) AS peak_pct_diff, round_even(sref / nullif(ref_peak * c, 0), 6) AS ref_load_factor, round_even(sreg / nullif(reg_peak * c, 0), 6) AS reg_load_factor
FROM t JOIN p a ON a.{keys} = t.{keys} AND a.ts = ref_peak_at JOIN p b ON b.{keys} = t.{keys} AND b.ts = reg_peak_at"""


@query(f"WITH {PAIRS}, p AS (SELECT * FROM pairs), {_peak_sql('nation')}")
def county_peaks(spark, sf_dir):
    return rounded(stats.peaks(pairs(spark, sf_dir), ["nation"]))


@query(f"WITH {PAIRS}, p AS (SELECT 1 AS one, ts, sum(ref) AS ref, sum(reg) AS reg FROM pairs GROUP BY ALL), {_peak_sql('one')}")
def national_peak_and_load_factor(spark, sf_dir):
    national = pairs(spark, sf_dir).groupBy("ts").agg(F.sum("ref").alias("ref"), F.sum("reg").alias("reg")).withColumn("one", F.lit(1))
    return rounded(stats.peaks(national, ["one"]))


@query(f"WITH {PAIRS} SELECT q::DOUBLE AS q, round_even(quantile_cont(ref, 0.90), 6) AS ref, round_even(quantile_cont(reg, 0.90), 6) AS reg, round_even(100 * (quantile_cont(reg, 0.90) - quantile_cont(ref, 0.90)) / quantile_cont(ref, 0.90), 6) AS pct_diff FROM pairs, (SELECT 0.9 AS q) GROUP BY q UNION ALL SELECT 0.95, round_even(quantile_cont(ref, 0.95), 6), round_even(quantile_cont(reg, 0.95), 6), round_even(100 * (quantile_cont(reg, 0.95) - quantile_cont(ref, 0.95)) / quantile_cont(ref, 0.95), 6) FROM pairs UNION ALL SELECT 0.99, round_even(quantile_cont(ref, 0.99), 6), round_even(quantile_cont(reg, 0.99), 6), round_even(100 * (quantile_cont(reg, 0.99) - quantile_cont(ref, 0.99)) / quantile_cont(ref, 0.99), 6) FROM pairs")
def load_percentiles(spark, sf_dir):
    return rounded(ranking.percentiles(pairs(spark, sf_dir)))


@query(
    " UNION ALL ".join(
        f"SELECT l_suppkey, {q}::DOUBLE AS q, round_even(quantile_cont(l_extendedprice, {q}), 6) AS ref, round_even(quantile_cont(l_quantity, {q}), 6) AS reg, round_even(100 * (quantile_cont(l_quantity, {q}) - quantile_cont(l_extendedprice, {q})) / quantile_cont(l_extendedprice, {q}), 6) AS pct_diff FROM lineitem GROUP BY l_suppkey"
        for q in (0.9, 0.95, 0.99)
    )
)
def load_percentiles_by_key(spark, sf_dir):
    """Percentiles of each supplier's prices and quantities; quantities are few values that many rows share."""
    items = read(spark, sf_dir, "lineitem").select("l_suppkey", F.col("l_extendedprice").alias("ref"), F.col("l_quantity").alias("reg"))
    return rounded(ranking.percentiles(items, ["l_suppkey"]))


# Places from 0: the middle starts at max(0, n // 2 - k // 2), ends k later or at n, and is moved back if it was cut; k = 3.
_BMW = """p AS (SELECT *, least(n, greatest(0, n // 2 - 3 // 2) + 3) AS stop FROM k), g AS (SELECT *, 'best' AS "group" FROM p WHERE rank - 1 < 3
UNION ALL SELECT *, 'middle' FROM p WHERE rank - 1 >= greatest(0, stop - 3) AND rank - 1 < stop UNION ALL SELECT *, 'worst' FROM p WHERE rank - 1 >= n - 3)"""


@query(f"WITH k AS (SELECT s_suppkey, s_acctbal, row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS rank, count(*) OVER () AS n FROM supplier WHERE s_acctbal IS NOT NULL), {_BMW} SELECT s_suppkey, s_acctbal, rank::INTEGER AS rank, \"group\" FROM g")
def best_middle_worst_even(spark, sf_dir):
    """As best_middle_worst, of an even number of rows."""
    return relational.best_middle_worst(read(spark, sf_dir, "supplier"), "s_acctbal", "s_suppkey")


@query(f"WITH {PAIRS}, e AS (SELECT nation, avg(abs(ref - reg)) / nullif(avg(ref), 0) AS nmae FROM pairs GROUP BY ALL), k AS (SELECT *, row_number() OVER (ORDER BY nmae, nation) AS rank, count(*) OVER () AS n FROM e), {_BMW} SELECT nation, round_even(nmae, 6) AS nmae, rank::INTEGER AS rank, \"group\" FROM g")
def best_middle_worst(spark, sf_dir):
    return rounded(relational.best_middle_worst(stats.errors(pairs(spark, sf_dir), ["nation"]).select("nation", "nmae"), "nmae", "nation"))


@query("SELECT n_regionkey, array_to_string(list_sort(list(DISTINCT n_name)), ',') AS states, count(DISTINCT n_name) > 1 AS several FROM nation GROUP BY ALL")
def ba_state_list(spark, sf_dir):
    return stats.state_lists(read(spark, sf_dir, "nation"), "n_regionkey", "n_name")


@query("WITH p AS (SELECT l_suppkey % 60 AS a, l_partkey % 45 AS b FROM lineitem), l AS (SELECT DISTINCT a AS v FROM p), m AS (SELECT DISTINCT b AS v FROM p), q AS (SELECT DISTINCT a, b FROM p) SELECT (SELECT count(*) FROM l) AS n_left, (SELECT count(*) FROM m) AS n_right, (SELECT count(*) FROM (SELECT v FROM l INTERSECT SELECT v FROM m)) AS n_both, (SELECT count(*) FROM (SELECT v FROM l EXCEPT SELECT v FROM m)) AS left_only, (SELECT count(*) FROM (SELECT v FROM m EXCEPT SELECT v FROM l)) AS right_only, (SELECT count(*) FROM q) AS n_pairs, (SELECT count(*) FROM q WHERE a = b) AS n_same")
def pair_set_compare(spark, sf_dir):
    p = read(spark, sf_dir, "lineitem").select((F.col("l_suppkey") % 60).alias("a"), (F.col("l_partkey") % 45).alias("b"))
    return relational.pair_sets(p, "a", "b")


@query("WITH l AS (SELECT DISTINCT l_suppkey AS v FROM lineitem), m AS (SELECT DISTINCT l_partkey AS v FROM lineitem), q AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem) SELECT (SELECT count(*) FROM l) AS n_left, (SELECT count(*) FROM m) AS n_right, (SELECT count(*) FROM (SELECT v FROM l INTERSECT SELECT v FROM m)) AS n_both, (SELECT count(*) FROM (SELECT v FROM l EXCEPT SELECT v FROM m)) AS left_only, (SELECT count(*) FROM (SELECT v FROM m EXCEPT SELECT v FROM l)) AS right_only, (SELECT count(*) FROM q) AS n_pairs, (SELECT count(*) FROM q WHERE a = b) AS n_same")
def pair_set_compare_all(spark, sf_dir):
    """pair_set_compare over all line items and their whole keys."""
    return relational.pair_sets(read(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey")


def _buyers(spark, sf_dir, status):
    return read(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias("k"))


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_intersect(spark, sf_dir):
    return _buyers(spark, sf_dir, "F").intersect(_buyers(spark, sf_dir, "P"))


@query("SELECT o_custkey AS k FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'P'")
def set_except(spark, sf_dir):
    return _buyers(spark, sf_dir, "F").subtract(_buyers(spark, sf_dir, "P"))


# Reshaping


@query("SELECT event_id, value, coalesce(user_id, -1) AS user_id FROM (SELECT event_id, value, NULL::BIGINT AS user_id FROM events WHERE event_type = 'view' UNION ALL BY NAME SELECT event_id, user_id FROM events WHERE event_type <> 'view')")
def union_by_name(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return e.where("event_type = 'view'").select("event_id", "value").unionByName(e.where("event_type <> 'view'").select("event_id", "user_id"), allowMissingColumns=True).na.fill(-1, ["user_id"])


_KINDS = ("click", "error", "purchase", "signup", "view")


@query(f"WITH {HOURLY} SELECT ts, " + ", ".join(f"round_even(max(v) FILTER (kind = '{k}'), 6) AS {k}" for k in _KINDS) + " FROM hourly GROUP BY ts")
def pivot_wide(spark, sf_dir):
    return rounded(relational.pivoted(hourly(spark, sf_dir).select("ts", "kind", "v"), ["ts"], "kind", "v", list(_KINDS)))


@query("SELECT l_orderkey, l_linenumber, name, value FROM (UNPIVOT (SELECT l_orderkey, l_linenumber, l_quantity, l_discount, l_tax FROM lineitem) ON l_quantity, l_discount, l_tax INTO NAME name VALUE value)")
def unpivot_long(spark, sf_dir):
    return relational.unpivoted(read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount", "l_tax"), ["l_orderkey", "l_linenumber"], "name", "value")


# Scalar functions


@query("""SELECT c_custkey, split_part(c_name, '#', 2) AS part, lower(c_mktsegment) AS low, coalesce(nullif(regexp_replace(trim(split_part(c_name, '#', 2)), '^0+', ''), ''), '0') AS fips,
'(''' || c_custkey || ''', ''' || c_mktsegment || ''')' AS key, lpad(c_custkey::VARCHAR, greatest(4, length(c_custkey::VARCHAR))::INTEGER, '0') AS padded, coalesce(nullif(regexp_replace(regexp_replace(c_name, '[^A-Za-z0-9_-]+', '-', 'g'), '^[-_]+|[-_]+$', '', 'g'), ''), 'unknown') AS slug,
replace(replace('<' || c_name || ' & "co">', '&', '&amp;'), '<', '&lt;').replace('>', '&gt;').replace('"', '&quot;') AS html,
c_name LIKE 'Customer%' AS starts, regexp_extract(c_name, '([0-9]+)', 1) AS digits, c_mktsegment || ', ' || c_nationkey AS place, ((lpad((c_nationkey + 1)::VARCHAR, 2, '0')) || lpad((c_custkey % 1000)::VARCHAR, 3, '0'))::INTEGER AS county FROM customer""")
def string_kit(spark, sf_dir):
    code = F.concat(F.lit("G"), F.lpad((F.col("c_nationkey") + 1).cast("string"), 2, "0"), F.lit("0"), F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), F.lit("0"))
    return read(spark, sf_dir, "customer").select(
        "c_custkey", F.coalesce(text.nth_part(F.col("c_name"), "#", 1), F.lit("")).alias("part"), F.lower("c_mktsegment").alias("low"), text.normal_fips(F.coalesce(text.nth_part(F.col("c_name"), "#", 1), F.lit(""))).alias("fips"),
        text.key_text("c_custkey", "c_mktsegment").alias("key"), text.padded(F.col("c_custkey")).alias("padded"), text.slug(F.col("c_name")).alias("slug"),
        text.html_escape(F.concat(F.lit("<"), F.col("c_name"), F.lit(' & "co">'))).alias("html"), F.col("c_name").startswith("Customer").alias("starts"), F.regexp_extract("c_name", "([0-9]+)", 1).alias("digits"),
        F.concat_ws(", ", "c_mktsegment", F.col("c_nationkey").cast("string")).alias("place"), text.county_fips(code).alias("county"),
    )


@query(
    "WITH v AS (SELECT p_partkey, replace(lower(p_name), ' ', chr(39)) || '-' || upper(p_type) AS name, sqrt(p_retailprice) AS share, sqrt(p_retailprice) * power(10, p_size % 13 - 7) AS any_size FROM part) "
    "SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(name, '[A-Za-z]+|[^A-Za-z]+'), lambda x: upper(x[1]) || lower(x[2:])), '') AS title, "
    "format('{:.2f}', share) AS two_places, format('{:,.3f}', share * 1000) AS grouped, format('{:.3g}', any_size) AS three_digits FROM v"
)
def text_formats(spark, sf_dir):
    """Title case after any mark, and numbers as reports show them."""
    name = F.concat(F.replace(F.lower("p_name"), F.lit(" "), F.lit("'")), F.lit("-"), F.upper("p_type"))
    share = F.sqrt("p_retailprice")
    any_size = share * F.pow(F.lit(10.0), F.col("p_size") % 13 - 7)
    return read(spark, sf_dir, "part").select(
        "p_partkey", text.title_case(name).alias("title"), text.fixed(share, 2).alias("two_places"),
        text.fixed(share * 1000, 3, grouped=True).alias("grouped"), text.significant(any_size).alias("three_digits"),
    )


@query(
    "WITH t AS (SELECT n_regionkey, n_nationkey, n_name FROM nation) SELECT n_nationkey, place::INTEGER AS place, "
    "CASE place WHEN 0 THEN n_regionkey::VARCHAR WHEN 1 THEN 'r' || n_regionkey || 'n' || n_nationkey WHEN 2 THEN n_nationkey::VARCHAR ELSE n_name END AS cell FROM t, range(4) p(place)"
)
def column_inserted_at_place(spark, sf_dir):
    """A column put in second place; every cell with the place that its column has."""
    df = read(spark, sf_dir, "nation").select("n_regionkey", "n_nationkey", "n_name")
    wide = relational.inserted(df, 1, "key", F.concat(F.lit("r"), "n_regionkey", F.lit("n"), "n_nationkey"))
    cells = F.array(*[F.col(c).cast("string") for c in wide.columns])
    return wide.select("n_nationkey", F.posexplode(cells).alias("place", "cell"))


@query("SELECT s_suppkey, CASE s_nationkey % 6 WHEN 1 THEN 'AL' WHEN 2 THEN 'AK' WHEN 4 THEN 'AZ' WHEN 5 THEN 'AR' END AS state FROM supplier")
def fips_to_state(spark, sf_dir):
    return read(spark, sf_dir, "supplier").select("s_suppkey", text.state_of(F.concat(F.lit("G0"), F.col("s_nationkey") % 6, F.lit("00010"))).alias("state"))


@query("SELECT o_orderkey, hour(o_orderdate)::INTEGER AS hour, month(o_orderdate)::INTEGER AS month, (isodow(o_orderdate) - 1)::INTEGER AS weekday, (isodow(o_orderdate) >= 6)::INTEGER AS weekend, ['DJF', 'MAM', 'JJA', 'SON'][(month(o_orderdate) % 12) // 3 + 1] AS season, strftime(o_orderdate, '%Y%m%d_%H%M') AS stamp, o_orderdate::DATE::VARCHAR AS day, o_orderdate + INTERVAL 1 HOUR AS later, o_orderdate AS parsed FROM orders")
def date_kit(spark, sf_dir):
    d = F.col("o_orderdate")
    return read(spark, sf_dir, "orders").select(
        "o_orderkey", F.hour(d).alias("hour"), F.month(d).alias("month"), F.weekday(d).alias("weekday"), dates.is_weekend(d).alias("weekend"), dates.season(d).alias("season"), F.date_format(d, "yyyyMMdd_HHmm").alias("stamp"),
        F.to_date(d).cast("string").alias("day"), dates.hour_begin_to_end(d).alias("later"), dates.parsed(F.date_format(d, "M/d/yyyy H:mm"), "M/d/yyyy H:mm").alias("parsed"),
    )


@query("SELECT event_id, CASE WHEN value IS NULL THEN NULL ELSE greatest(value - 50, 0) END AS clipped, coalesce(value BETWEEN 20 AND 60, FALSE) AS inside, isfinite(value) AS finite, round_even(100 / nullif(round(value), 0), 6) AS guarded, CASE WHEN value < 30 THEN 'low' WHEN value < 70 THEN 'mid' ELSE 'high' END AS band, round_even(sqrt(abs(value)), 6) AS root, (user_id // 7)::BIGINT AS week, user_id::VARCHAR AS name FROM events")
def clip_null_case_kit(spark, sf_dir):
    v = F.col("value")
    return read(spark, sf_dir, "events").select(
        "event_id", numeric.clip_low(v - 50).alias("clipped"), F.coalesce(v.between(20, 60), F.lit(False)).alias("inside"), numeric.is_finite(v).alias("finite"), r(numeric.safe_div(F.lit(100.0), F.round(v))).alias("guarded"),
        F.when(v < 30, "low").when(v < 70, "mid").otherwise("high").alias("band"), r(F.sqrt(F.abs(v))).alias("root"), F.floor(F.col("user_id") / 7).alias("week"), F.col("user_id").cast("string").alias("name"),
    )


@query("SELECT l_orderkey, l_linenumber, round_even(coalesce(l_quantity, 0) + coalesce(l_discount, 0) + coalesce(l_tax, 0), 6) AS uses, round_even(l_extendedprice / 1000, 6) AS mwh, round_even(l_extendedprice / 1000 / 1000, 9) AS gwh, round_even(l_extendedprice * 0.293071::DOUBLE, 8) AS kwh FROM lineitem")
def unit_conversions(spark, sf_dir):
    p = F.col("l_extendedprice")
    return read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", r(numeric.row_sum("l_quantity", "l_discount", "l_tax")).alias("uses"), numeric.kwh_to_mwh(p).alias("mwh"), r(numeric.mwh_to_gwh(p / 1000), 9).alias("gwh"), r(numeric.kbtu_to_kwh(p), 8).alias("kwh"))


# Reconciliation and models

_REC = "SELECT s_nationkey AS nation, sum(l_extendedprice) / 1e6 AS hvac, sum(l_quantity) / 1e3 AS gas FROM lineitem JOIN supplier ON l_suppkey = s_suppkey"


def _rec_sql() -> str:
    pairs_ = (("series", "meta"), ("reg", "meta"), ("reg", "series"))
    columns = ["nation", *[f"round_even({m}_{s}, 6) AS {m}_{s}" for s in ("meta", "series", "reg") for m in ("hvac", "gas")]]
    columns += [f"round_even({m}_{a} / nullif({m}_{b}, 0), 4) AS ratio_{m}_{a}_{b}" for m in ("hvac", "gas") for a, b in pairs_]
    columns += [f"round_even(100 * ({m}_{a} - {m}_{b}) / nullif({m}_{b}, 0), 4) AS diff_{m}_{a}_{b}" for m in ("hvac", "gas") for a, b in pairs_]
    side = lambda s, where: f"{s} AS (SELECT nation, hvac AS hvac_{s}, gas AS gas_{s} FROM ({_REC} {where} GROUP BY 1))"
    return f"WITH {side('meta', '')}, {side('series', 'WHERE l_linenumber <= 4')}, {side('reg', 'WHERE l_linenumber > 2 AND s_nationkey <> 3')} SELECT {', '.join(columns)} FROM meta LEFT JOIN series USING (nation) LEFT JOIN reg USING (nation)"


@query(_rec_sql())
def ratio_pctdiff_reconcile(spark, sf_dir):
    items = read(spark, sf_dir, "lineitem").join(read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("nation")), "l_suppkey")
    side = lambda df: df.groupBy("nation").agg((F.sum("l_extendedprice") / 1e6).alias("hvac"), (F.sum("l_quantity") / 1e3).alias("gas"))
    return rounded(rec.reconcile(side(items), side(items.where("l_linenumber <= 4")), side(items.where("l_linenumber > 2 AND nation <> 3")), ["nation"], ["hvac", "gas"]))


_HALF = "t AS (SELECT kind, min(v) AS lo, max(v) AS hi FROM hourly WHERE day(ts) <= 15 GROUP BY ALL)"


@query(f"WITH {HOURLY}, {_HALF} SELECT kind, ts, round_even(CASE WHEN v BETWEEN lo AND hi THEN 2 * v ELSE v + 1 END, 6) AS value, v BETWEEN lo AND hi AS inside, round_even(avg((v NOT BETWEEN lo AND hi)::INTEGER) OVER (PARTITION BY kind) * 100, 6) AS share FROM hourly JOIN t USING (kind) WHERE day(ts) > 15")
def hybrid_select(spark, sf_dir):
    h = hourly(spark, sf_dir).select("kind", "ts", "v")
    seen = h.where(F.dayofmonth("ts") <= 15).groupBy("kind").agg(F.min("v").alias("lo"), F.max("v").alias("hi"))
    new = h.where(F.dayofmonth("ts") > 15).join(seen, "kind").withColumn("inside", F.col("v").between(F.col("lo"), F.col("hi")))
    share = F.avg((~F.col("inside")).cast("int")).over(Window.partitionBy("kind")) * 100
    return rounded(new.select("kind", "ts", F.when(F.col("inside"), 2 * F.col("v")).otherwise(F.col("v") + 1).alias("value"), "inside", share.alias("share")))


@query(f"WITH {HOURLY}, p AS (SELECT kind, v, lag(v) OVER (PARTITION BY kind ORDER BY ts) AS w FROM hourly) SELECT kind, round_even(avg(abs(v - w)), 6) AS mae, round_even(avg((v - w) * (v - w)), 4) AS mse, round_even(1 - avg((v - w) * (v - w)) / nullif(var_pop(v), 0), 6) AS r2 FROM p WHERE w IS NOT NULL GROUP BY ALL")
def model_metrics(spark, sf_dir):
    h = series.lagged(hourly(spark, sf_dir).select("kind", "ts", "v"), ["kind"], "v", [1])
    return stats.model_metrics(h, ["kind"], "v", "v_lag_1").select("kind", r("mae").alias("mae"), r("mse", 4).alias("mse"), r("r2").alias("r2"))


@query(f"WITH {HOURLY} SELECT kind, round_even(avg(v), 6) AS mean, round_even(stddev_pop(v), 6) AS spread FROM hourly GROUP BY ALL")
def scaler_stats(spark, sf_dir):
    return rounded(hourly(spark, sf_dir).groupBy("kind").agg(F.avg("v").alias("mean"), F.stddev_pop("v").alias("spread")))


@query(f"WITH {HOURLY}, n AS (SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY ts) AS i FROM hourly) SELECT kind, (('0x' || md5(kind || '|' || i || '|42')[1:8])::BIGINT % 5)::INTEGER AS fold, count(*) AS n FROM n GROUP BY ALL")
def hash_split_counts(spark, sf_dir):
    """Rows of each part of the deterministic split."""
    h = series.numbered(hourly(spark, sf_dir), ["kind"], name="hour_no")
    return h.groupBy("kind", regress.split_fold(["kind"], 5).alias("fold")).agg(F.count(F.lit(1)).alias("n"))


def _weathers(spark, sf_dir):
    """Hourly values, base and target weather, features: event counts play the weather, the first half of the month is the base, the second the target."""
    h = hourly(spark, sf_dir)
    weather = wx.weather_features(h.select(F.col("kind").alias("county"), "ts", F.col("n").cast("double").alias("dry_bulb"), F.col("v").alias("humidity")), ["county"], ["dry_bulb", "humidity"])
    return h, weather.where(F.dayofmonth("ts") <= 15), weather.where(F.dayofmonth("ts") > 15), wx.feature_names(["dry_bulb", "humidity"], wx.LAGS, "dry_bulb")


def _translation(spark, sf_dir, settings):
    h, base, target, features = _weathers(spark, sf_dir)
    # Values play the load.
    load = h.where(F.dayofmonth("ts") <= 15).select("kind", F.col("kind").alias("county"), "ts", F.col("v").alias("hvac"), F.lit(0.0).alias("gas"))
    return regress.translate(load, base, target, ["kind"], ["county"], ["hvac", "gas"], features, "dry_bulb", settings)


_WHOLE = regress.Settings(folds=5)


@query()
def regression_pipeline(spark, sf_dir):
    """Profiles of the target hours by forest and network; random models have no counterpart in the other engine."""
    return _translation(spark, sf_dir, _WHOLE)[0]


@query()
def regression_metrics(spark, sf_dir):
    """Held-out errors, fold errors, importances and the extrapolated share of each group's fit."""
    return _translation(spark, sf_dir, _WHOLE)[1]


@query(f"WITH {HOURLY}, t AS (SELECT unnest(['gas', 'hvac']) AS target) SELECT kind, target, ts, TRUE AS known, TRUE AS not_negative, target = 'gas' AS zero FROM hourly, t WHERE day(ts) > 15")
def regression_rows(spark, sf_dir):
    """What does not hang on chance in regression_pipeline: its stamps, that no value is missing or negative, and that only loads of nothing are zero all through."""
    found = _translation(spark, sf_dir, _WHOLE)[0]
    zero = F.max("value").over(Window.partitionBy("kind", "target")) == 0
    return found.select("kind", "target", "ts", F.col("value").isNotNull().alias("known"), (F.col("value") >= 0).alias("not_negative"), zero.alias("zero"))


@query(f"WITH {HOURLY}, s AS (SELECT kind, min(n) FILTER (day(ts) <= 15 AND ts < m) AS lo, max(n) FILTER (day(ts) <= 15 AND ts < m) AS hi FROM (SELECT *, max(ts) FILTER (day(ts) <= 15) OVER (PARTITION BY kind) AS m FROM hourly) GROUP BY kind), o AS (SELECT kind, 100 * avg((n NOT BETWEEN lo AND hi)::INTEGER) AS share FROM hourly JOIN s USING (kind) WHERE day(ts) > 15 GROUP BY kind) SELECT kind, 'hvac' AS target, round_even(share, 6) AS share_extrapolated, 1.0::DOUBLE AS importances, (CASE WHEN share > 0 THEN 5 ELSE 0 END)::BIGINT AS network_folds FROM o")
def regression_sums(spark, sf_dir):
    """What does not hang on chance in regression_metrics: shares of extrapolated hours, importances that sum to 1, and a network error for each fold where hours are extrapolated."""
    fits = _translation(spark, sf_dir, _WHOLE)[1]
    pick = lambda c: F.sum(F.when(c, F.col("value")))
    return fits.groupBy("kind", "target").agg(
        r(pick(F.col("name") == "share_extrapolated")).alias("share_extrapolated"), r(pick(F.col("what") == "importance")).alias("importances"),
        F.count(F.when(F.col("name").startswith("network_fold_mse_") & F.col("value").isNotNull(), 1)).alias("network_folds"),
    )


#: Seen temperatures, as regression_sums has them: base hours but the last.
_SEEN = (
    "m AS (SELECT *, max(ts) FILTER (day(ts) <= 15) OVER (PARTITION BY kind) AS m FROM hourly), "
    "s AS (SELECT kind, min(n) AS lo, max(n) AS hi FROM m WHERE day(ts) <= 15 AND ts < m GROUP BY kind)"
)
#: What trees and epochs have no part in: one of each is enough.
_LEAST = regress.Settings(trees=1, epochs=1)


@query(
    f"WITH {HOURLY}, {_SEEN} SELECT kind, (row_number() OVER (PARTITION BY kind ORDER BY ts))::INTEGER AS hour_no, "
    "CASE WHEN n BETWEEN lo AND hi THEN 'forest' ELSE 'network' END AS model FROM hourly JOIN s USING (kind) WHERE day(ts) > 15"
)
def model_of_hours(spark, sf_dir):
    """Which model predicts each target hour."""
    h, base, target, features = _weathers(spark, sf_dir)
    load = h.where(F.dayofmonth("ts") <= 15).select("kind", F.col("kind").alias("county"), "ts", F.col("v").alias("y"))
    found = regress.fit_predict(load, base, target, ["kind"], ["county"], features, "dry_bulb", _LEAST)
    return found.where("what = 'prediction'").select("kind", "hour_no", F.col("name").alias("model"))


_FEATURES = (
    "f AS (SELECT kind, ts, v, n::DOUBLE AS dry_bulb, v AS humidity, hour(ts)::DOUBLE AS hour, (isodow(ts) >= 6)::INTEGER::DOUBLE AS weekend, "
    "(lead(n, 1) OVER w)::DOUBLE AS dry_bulb_lag_m1, "
    + ", ".join(f"coalesce(lag(n, {k}) OVER w, first_value(n) OVER w)::DOUBLE AS dry_bulb_lag_{k}" for k in (1, 3, 6, 12))
    + " FROM hourly WINDOW w AS (PARTITION BY kind ORDER BY ts)), "
    "b AS (SELECT *, lead(v) OVER (PARTITION BY kind ORDER BY ts) AS y FROM f WHERE day(ts) <= 15), "
    "u AS (UNPIVOT (SELECT * EXCLUDE (ts, v) FROM b WHERE y IS NOT NULL) ON COLUMNS(* EXCLUDE (kind)) INTO NAME name VALUE x), "
    "o AS (SELECT kind FROM hourly JOIN s USING (kind) WHERE day(ts) > 15 GROUP BY kind HAVING bool_or(n NOT BETWEEN lo AND hi))"
)


@query(
    f"WITH {HOURLY}, {_SEEN}, {_FEATURES} SELECT kind, 'hvac' AS target, name, round_even(avg(x), 6) AS mean, "
    "round_even(CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END, 6) AS spread FROM u SEMI JOIN o USING (kind) GROUP BY kind, name"
)
def network_scales(spark, sf_dir):
    """By which the network standardises each feature and the load: means and deviations over all base hours."""
    fits = _translation(spark, sf_dir, _LEAST)[1]
    pick = lambda what: F.max(F.when(F.col("what") == what, F.col("value")))
    found = fits.where(F.col("what").isin("scale_mean", "scale_spread")).groupBy("kind", "target", "name")
    return rounded(found.agg(pick("scale_mean").alias("mean"), pick("scale_spread").alias("spread")))


_ACTUAL = "a AS (SELECT kind, ts, v, v * 1.1 + 2 AS p FROM hourly)"


@query(f"WITH {HOURLY}, {_ACTUAL} SELECT kind, 'v' AS target, round_even(avg(abs(v - p)), 6) AS mae, round_even(avg((v - p) * (v - p)), 4) AS mse, round_even(1 - avg((v - p) * (v - p)) / nullif(var_pop(v), 0), 6) AS r2 FROM a GROUP BY ALL")
def target_year_test(spark, sf_dir):
    h = hourly(spark, sf_dir).select("kind", "ts", "v")
    profiles = h.select("kind", F.lit("v").alias("target"), "ts", (F.col("v") * 1.1 + 2).alias("value"))
    out = regress.target_year_test(profiles, h.toDF(*h.columns), ["kind"], ["v"])
    return out.select("kind", "target", r("mae").alias("mae"), r("mse", 4).alias("mse"), r("r2").alias("r2"))


# Sources and sinks: written and read again


@query(f"WITH {HOURLY} SELECT kind AS fips, ts, round_even(v, 6) AS gwh FROM hourly")
def wide_csv_round_trip(spark, sf_dir):
    path = scratch.folder(spark)
    h = hourly(spark, sf_dir).select("ts", "kind", "v")
    writers.wide_loads(h, path, "kind", "v", list(_KINDS))
    return readers.wide_series(spark, path).where(F.col("gwh").isNotNull()).select("fips", "ts", "gwh")


@query("SELECT o_orderkey, o_totalprice, o_orderstatus, o_orderpriority FROM orders WHERE o_orderstatus IN ('F', 'O')")
def partitioned_scan(spark, sf_dir):
    path = scratch.folder(spark)
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    writers.to_parquet(o, path, ["o_orderstatus"])
    return readers.buildings(spark, path, o.schema, states=["F", "O"], state="o_orderstatus").select(*o.columns)


@query(f"WITH {HOURLY}, m AS (SELECT kind, avg(v) AS mae, max(v) AS mse FROM hourly GROUP BY 1) SELECT round_even(avg(mae), 6) AS mae, round_even(avg(mse), 6) AS mse FROM m")
def metrics_append_mean(spark, sf_dir):
    path = scratch.folder(spark)
    m = hourly(spark, sf_dir).groupBy("kind").agg(F.avg("v").alias("mae"), F.max("v").alias("mse"))
    for chunk, part in ((0, F.col("kind") <= "purchase"), (1, F.col("kind") > "purchase"), (1, F.col("kind") > "purchase")):
        writers.append_metrics(m.where(part), path, "first run", chunk)  # the last task runs twice
    return writers.mean_metrics(spark.read.parquet(path), ["kind"])


@query(f"WITH {PAIRS} SELECT n_regionkey AS upgrade, '(''' || n_name || ''', ' || nation || ')' AS bldg_id, ts, round_even(ref, 8) AS mwh FROM pairs JOIN nation ON nation = n_nationkey WHERE n_regionkey IN (1, 3)")
def chunk_files_round_trip(spark, sf_dir):
    """Wide load files, one for each upgrade (region) and chunk of four nations, read again by upgrade; each has columns of its own."""
    path = scratch.folder(spark)
    nations = read(spark, sf_dir, "nation").select(F.col("n_regionkey").alias("upgrade"), F.col("n_nationkey").alias("nation"), "n_name")
    series_name = F.concat(F.lit("('"), "n_name", F.lit("', "), "nation", F.lit(")")).alias("name")
    loads = pairs(spark, sf_dir).join(nations, "nation").select("upgrade", "nation", "ts", series_name, F.col("ref").alias("value"))
    writers.chunk_loads(loads, rollup.chunked(nations, ["nation"], 4), ["nation"], 4, path, "res_", "loads", places=8)
    of = lambda u: readers.chunk_series(spark, path, "res_loads", u).select(F.lit(u).alias("upgrade"), "bldg_id", "ts", "mwh")
    return of(1).unionByName(of(3)).where(F.col("mwh").isNotNull())


@query("SELECT o_orderstatus AS state, count(*) AS n, FALSE AS skipped FROM orders GROUP BY ALL UNION ALL SELECT 'BROKEN', 0, TRUE")
def scan_without_broken_files(spark, sf_dir):
    """Orders by status in partitions, one more partition with a file that is no Parquet: it is skipped and named, the rest is read."""
    path = scratch.folder(spark)
    o = read(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("state"), F.col("o_orderpriority").alias("county"))
    writers.to_parquet(o, path, ["state", "county"])
    writers.write_text(spark, ["no parquet"], f"{path}/state=BROKEN/county=x")
    rows, skipped = readers.readable(spark, path, o.schema)
    counts = rows.groupBy("state").agg(F.count(F.lit(1)).alias("n")).withColumn("skipped", F.lit(False))
    return counts.unionByName(skipped.where("file LIKE '%part-%'").select("state", F.lit(0).cast("long").alias("n"), F.lit(True).alias("skipped")))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus IN ('F', 'P') AND o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_totalprice > 100000 AND (o_custkey % 2 = 0 OR o_totalprice < 200000)")
def warehouse_scan(spark, sf_dir):
    """A saved table in partitions, read with given lists of values and conditions as text."""
    name = f"orders_{uuid.uuid4().hex}"
    o = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus", "o_orderpriority")
    warehouse.save(o, name, ["o_orderstatus", "o_orderpriority"], scratch.folder(spark))
    restrict = [("o_orderstatus", ["F", "P"]), ("o_orderpriority", ["1-URGENT", "2-HIGH"])]
    return warehouse.scan(spark, name, ["o_orderkey", "o_totalprice"], restrict, ["o_totalprice > 100000", "o_custkey % 2 = 0 OR o_totalprice < 200000"])


_USES = "coalesce(l_quantity, 0) + coalesce(l_discount, 0)"


@query(f"SELECT l_returnflag AS county, 2 * round_even(sum(({_USES}) * l_linenumber) / 1000, 6) AS hvac_mwh, 2 * round_even(sum(l_tax * 0.293071 * l_linenumber) / 1000, 6) AS gas_mwh FROM lineitem GROUP BY ALL")
def releases_in_one_schema(spark, sf_dir):
    """Line items under the names of two releases, gas in kWh and in kBtu; both give the same totals, which are added up."""
    items = read(spark, sf_dir, "lineitem").select("l_orderkey", F.col("l_linenumber").cast("double").alias("w"), "l_returnflag", "l_quantity", "l_discount", "l_tax")
    old = items.toDF("building_id", "build_existing_model.sample_weight", "build_existing_model.county", "end_use__electricity__heating__kwh", "end_use__electricity__cooling__kwh", "end_use__natural_gas__heating__kbtu")
    new = items.withColumn("l_tax", F.col("l_tax") * numeric.KWH_PER_KBTU)
    new = new.toDF("bldg_id", "weight", "in.county", "out.electricity.heating.energy_consumption..kwh", "out.electricity.cooling.energy_consumption..kwh", "out.natural_gas.heating.energy_consumption..kwh")
    sides = []
    for df, release in ((old, "2024.2"), (new, "2025.1")):
        found = schema.resolve(df, readers.RunConfig(stock="residential", release=release))
        sides.append(rollup.metadata_rollup(found.df, ["county"], found.electric, found.gas))
    return sides[0].unionByName(sides[1]).groupBy("county").agg(r(F.sum("hvac_mwh")).alias("hvac_mwh"), r(F.sum("gas_mwh")).alias("gas_mwh"))


@query(f"WITH {PAIRS}, k AS (SELECT nation, least(ref, reg) AS a, greatest(ref, reg) AS b, ref, reg FROM pairs), m AS (SELECT nation, min(a) AS low, max(b) AS high, avg(abs(ref - reg)) AS mae FROM k GROUP BY ALL) SELECT nation::VARCHAR AS \"of\", least(59, floor((ref - low) / (high - low) * 60))::INTEGER AS x, least(59, floor((reg - low) / (high - low) * 60))::INTEGER AS y, count(*) AS n, round_even(mae, 6) AS mae FROM k JOIN m USING (nation) GROUP BY ALL")
def scatter_cells(spark, sf_dir):
    """Scatters of each nation's days as counts in cells, which charts draw."""
    return charts.cells(pairs(spark, sf_dir), F.col("nation").cast("string")).select("of", "x", "y", "n", r("mae").alias("mae"))


@query("SELECT DISTINCT s_nationkey::VARCHAR AS nation, CASE WHEN s_nationkey IN (1, 7) THEN 'a, \"b\"' ELSE 'plain' END AS note FROM supplier")
def lookup_csv_round_trip(spark, sf_dir):
    """A lookup of repeated rows written as CSV and read under other names, each row once; fields hold commas and quotes."""
    path = scratch.folder(spark)
    note = F.when(F.col("s_nationkey").isin(1, 7), 'a, "b"').otherwise("plain").alias("in.note")
    read(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("in.nation"), note).write.option("header", True).option("escape", '"').csv(path)
    return readers.lookup(spark, path, {"in.nation": "nation", "in.note": "note"})


@query(f"WITH {PAIRS} SELECT n_regionkey::VARCHAR AS state, nation::VARCHAR AS county, year(ts)::INTEGER AS year, ts, round_even(ref, 8) AS dry_bulb, CASE WHEN month(ts) > 1 THEN round_even(reg, 6) END AS humidity FROM pairs JOIN nation ON nation = n_nationkey WHERE year(ts) = 1996")
def weather_files_round_trip(spark, sf_dir):
    """A CSV file for each nation and year under its region, as weather comes; one year is read again, in one scan."""
    path = scratch.folder(spark)
    regions = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), "n_regionkey")
    p = pairs(spark, sf_dir).join(regions, "nation")
    measures = {**{c: F.lit(0.0) for c in readers.WEATHER_COLUMNS}, "Dry Bulb Temperature [°C]": r("ref", 8), "Relative Humidity [%]": F.when(F.month("ts") > 1, r("reg"))}
    file = F.concat(F.lit("state="), "n_regionkey", F.lit("/"), "nation", F.lit("_"), F.year("ts"), F.lit(".csv"))
    rows = p.select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("date_time"), *[c.alias(n) for n, c in measures.items()], file.alias("file"))
    writers.named_csv(rows, path, "file", ["date_time"])
    return readers.weather(spark, path, 1996).select(F.col("state").cast("string").alias("state"), "county", "year", "ts", "dry_bulb", "humidity")


@query("SELECT regexp_replace(trim(p_brand), '^0+', '') AS fips, arg_min(p_name, p_partkey) AS ba, arg_min(p_type, p_partkey) AS state FROM part GROUP BY 1")
def zones_first_row(spark, sf_dir):
    """A zone table whose entities come several times: the first row of each counts, as a whole."""
    path = scratch.folder(spark)
    p = read(spark, sf_dir, "part").orderBy("p_partkey").select(F.col("p_brand").alias("FIPS"), F.col("p_name").alias("ba"), F.lit("x").alias("county_name"), F.col("p_type").alias("state"))
    writers.to_csv(p, path, single=True)
    return readers.zones(spark, path).select("fips", "ba", "state")


@query("""WITH f AS (SELECT 'o' || o_orderstatus AS p, (o_custkey % 3)::INTEGER AS u, min(o_orderkey) * 15 AS s FROM orders GROUP BY ALL UNION SELECT 'o' || o_orderstatus, (o_custkey % 3)::INTEGER, max(o_orderkey) * 15 FROM orders GROUP BY ALL),
n AS (SELECT p, u, s, s + 15 AS e, lead(s) OVER (PARTITION BY p, u ORDER BY s) AS nx FROM f), pad AS (SELECT p, u, lpad(s::VARCHAR, greatest(4, length(s::VARCHAR))::INTEGER, '0') || '-' || lpad((s + 15)::VARCHAR, greatest(4, length((s + 15)::VARCHAR))::INTEGER, '0') AS r, s FROM f)
SELECT 'Total files found: ' || count(*) AS line FROM f GROUP BY p, u UNION ALL SELECT 'Results for ' || p || ' (upgrade ' || u || '):' FROM f GROUP BY p, u
UNION ALL SELECT 'First file: ' || p || '_upgrade' || u || '_' || arg_min(r, s) || '.csv' FROM pad GROUP BY p, u UNION ALL SELECT 'Last file: ' || p || '_upgrade' || u || '_' || arg_max(r, s) || '.csv' FROM pad GROUP BY p, u
UNION ALL SELECT 'Misaligned: ' || a.p || '_upgrade' || a.u || '_' || a.r || '.csv -> ' || b.p || '_upgrade' || b.u || '_' || b.r || '.csv' FROM n JOIN pad a ON a.p = n.p AND a.u = n.u AND a.s = n.s JOIN pad b ON b.p = n.p AND b.u = n.u AND b.s = n.nx WHERE n.nx <> n.e
UNION ALL SELECT 'Missing: ' || p || '_upgrade' || u || '_' || lpad(g::VARCHAR, greatest(4, length(g::VARCHAR))::INTEGER, '0') || '-' || lpad(least(g + 15, nx)::VARCHAR, greatest(4, length(least(g + 15, nx)::VARCHAR))::INTEGER, '0') || '.csv' FROM (SELECT p, u, nx, unnest(generate_series(e, nx - 1, 15)) AS g FROM n WHERE nx > e)""")
def chunk_files_report(spark, sf_dir):
    """Report lines on chunk files: those of the first and the last order of each status and upgrade, and all that lack between."""
    of = read(spark, sf_dir, "orders").groupBy(F.concat(F.lit("o"), "o_orderstatus").alias("prefix"), (F.col("o_custkey") % 3).cast("int").alias("upgrade"))
    ends = of.agg(F.explode(F.array_distinct(F.array(F.min("o_orderkey") * 15, F.max("o_orderkey") * 15))).alias("start"))
    return validation.files_report(ends.withColumn("end", F.col("start") + 15), 15)
