"""Keyed sync operators on the benchmark tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import SinkField
from ..operators import sync
from ..operators.quality import value_counts
from ..plans import dashboard
from ..schemas import DASHBOARD, SOCIAL_POSTS
from ..session import scratch_path, stored
from ..sources import tables
from . import models
from .base import cents, query, sql_cents, table

_COPY = 1_000_000_000_000

# Records to sync: every customer; poor ones are reported twice, some have no name.
SOURCE = f"""
SELECT c_custkey AS source_order, CASE WHEN c_nationkey <> 3 THEN c_name END AS name,
       CASE WHEN c_nationkey <> 7 THEN c_mktsegment END AS segment,
       {sql_cents('c_acctbal')} AS balance FROM customer
UNION ALL
SELECT c_custkey + {_COPY}, upper(c_name), c_mktsegment, {sql_cents('c_acctbal')}
FROM customer WHERE c_acctbal < 0"""

# The copy: all customers but one segment, partly outdated, rich ones twice,
# and the suppliers as records the source does not know.
TARGET = f"""
SELECT 't' || c_custkey AS id, c_custkey AS seq, '  ' || upper(c_name) || ' ' AS name,
       CASE WHEN c_nationkey < 5 THEN 'OLD' ELSE c_mktsegment || ' ' END AS segment,
       {sql_cents('c_acctbal')} AS balance, c_custkey % 10 AS note
FROM customer WHERE c_mktsegment <> 'BUILDING'
UNION ALL
SELECT 'd' || c_custkey, c_custkey + {_COPY}, c_name, 'STALE', NULL, NULL
FROM customer WHERE c_acctbal > 8000
UNION ALL
SELECT 's' || s_suppkey, s_suppkey + {2 * _COPY}, s_name, 'SUPPLIER', 0, NULL FROM supplier
UNION ALL
SELECT 'n' || s_suppkey, s_suppkey + {3 * _COPY}, NULL, 'NAMELESS', 0, NULL FROM supplier"""


def source_records(spark, d) -> DataFrame:
    customers = table(spark, d, "customer")
    once = customers.select(
        F.col("c_custkey").alias("source_order"),
        F.when(F.col("c_nationkey") != 3, F.col("c_name")).alias("name"),
        F.when(F.col("c_nationkey") != 7, F.col("c_mktsegment")).alias("segment"),
        cents("c_acctbal").alias("balance"))
    again = customers.filter(F.col("c_acctbal") < 0).select(
        (F.col("c_custkey") + _COPY).alias("source_order"), F.upper("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), cents("c_acctbal").alias("balance"))
    return once.unionByName(again)


def target_records(spark, d) -> DataFrame:
    customers, suppliers = table(spark, d, "customer"), table(spark, d, "supplier")
    key, supp = F.col("c_custkey"), F.col("s_suppkey")

    def tagged(tag, col):
        return F.concat(F.lit(tag), col.cast("string")).alias("id")
    null = F.lit(None).cast("bigint")
    main = customers.filter(F.col("c_mktsegment") != "BUILDING").select(
        tagged("t", key), key.alias("seq"),
        F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")).alias("name"),
        F.when(F.col("c_nationkey") < 5, "OLD").otherwise(F.concat("c_mktsegment", F.lit(" ")))
        .alias("segment"), cents("c_acctbal").alias("balance"), (key % 10).alias("note"))
    twice = customers.filter(F.col("c_acctbal") > 8000).select(
        tagged("d", key), (key + _COPY).alias("seq"), F.col("c_name").alias("name"),
        F.lit("STALE").alias("segment"), null.alias("balance"), null.alias("note"))
    strange = suppliers.select(
        tagged("s", supp), (supp + 2 * _COPY).alias("seq"), F.col("s_name").alias("name"),
        F.lit("SUPPLIER").alias("segment"), F.lit(0).cast("bigint").alias("balance"), null.alias("note"))
    nameless = suppliers.select(
        tagged("n", supp), (supp + 3 * _COPY).alias("seq"), F.lit(None).cast("string").alias("name"),
        F.lit("NAMELESS").alias("segment"), F.lit(0).cast("bigint").alias("balance"), null.alias("note"))
    return main.unionByName(twice).unionByName(strange).unionByName(nameless)


PLAN = f"""
WITH s AS (SELECT *, lower(trim(coalesce(name, ''))) AS k FROM ({SOURCE})),
s1 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY source_order) AS rn FROM s),
t AS (SELECT *, lower(trim(coalesce(name, ''))) AS k FROM ({TARGET})),
t1 AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY seq DESC) AS rn FROM t),
kept AS (SELECT * FROM t1 WHERE rn = 1),
plan AS (
SELECT CASE WHEN kept.id IS NULL THEN 'create'
            WHEN (s1.name IS NOT NULL AND trim(s1.name) IS DISTINCT FROM trim(kept.name))
              OR (s1.segment IS NOT NULL AND trim(s1.segment) IS DISTINCT FROM trim(kept.segment))
              OR (s1.balance IS NOT NULL AND s1.balance IS DISTINCT FROM kept.balance) THEN 'update'
            ELSE 'skip' END AS action,
       kept.id, s1.source_order, s1.name, s1.segment, s1.balance
FROM s1 LEFT JOIN kept ON kept.k = s1.k AND s1.rn = 1
UNION ALL
SELECT 'stale', id, NULL, NULL, NULL, NULL FROM kept WHERE k NOT IN (SELECT k FROM s)
UNION ALL
SELECT 'duplicate', id, NULL, NULL, NULL, NULL FROM t1 WHERE rn > 1)"""


def plan_of(spark, d) -> DataFrame:
    return sync.upsert_plan(source_records(spark, d), target_records(spark, d), ["name"])


query("upsert_plan", f"{PLAN} SELECT * FROM plan")(plan_of)


@query("apply_plan", f"""{PLAN}
SELECT t.id, t.seq,
       CASE WHEN p.action = 'update' THEN coalesce(p.name, t.name) ELSE t.name END AS name,
       CASE WHEN p.action = 'update' THEN coalesce(p.segment, t.segment) ELSE t.segment END AS segment,
       CASE WHEN p.action = 'update' THEN coalesce(p.balance, t.balance) ELSE t.balance END AS balance,
       t.note
FROM ({TARGET}) t LEFT JOIN plan p ON p.id = t.id
WHERE coalesce(p.action, 'skip') NOT IN ('stale', 'duplicate')
UNION ALL
SELECT 'new:' || source_order, NULL, name, segment, balance, NULL FROM plan WHERE action = 'create'""")
def applied(spark, d):
    """The target after the sync, stale records and extra copies removed."""
    return sync.apply_plan(target_records(spark, d), stored(plan_of(spark, d), "plan"), prune=True, dedupe=True)


@query("sync_stats", f"""{PLAN}
SELECT count(*) FILTER (action IN ('create', 'update', 'skip')) AS rows_read,
       count(*) FILTER (action = 'create') AS created, count(*) FILTER (action = 'update') AS updated,
       count(*) FILTER (action = 'skip') AS skipped,
       count(*) FILTER (action = 'duplicate') AS deduplicated, count(*) FILTER (action = 'stale') AS pruned
FROM plan""")
def stats(spark, d):
    return sync.sync_stats(plan_of(spark, d), prune=True, dedupe=True)


@query("duplicate_counts", f"""
SELECT count(*) AS records_now, count(DISTINCT k) AS distinct_keys,
       count(*) - count(DISTINCT k) AS extra_copies, count(DISTINCT k) AS records_after
FROM (SELECT lower(trim(coalesce(name, ''))) AS k FROM ({TARGET}))""")
def duplicate_counts(spark, d):
    return sync.duplicate_counts(target_records(spark, d), ["name"])


# --- duplicate report -----------------------------------------------------

_SHIPPED = {
    "part": "CAST(l_partkey AS VARCHAR)", "supplier": "CAST(l_suppkey AS VARCHAR)",
    "quantity": f"CAST({sql_cents('l_quantity')} AS VARCHAR)",
    "price": f"CAST({sql_cents('l_extendedprice')} AS VARCHAR)",
    "flag": "l_returnflag", "status": "l_linestatus",
    "shipped": "strftime(l_shipdate, '%Y-%m-%d')"}
_LINES = f"""
SELECT DISTINCT l_orderkey, l_linenumber, {', '.join(f'{e} AS "{n}"' for n, e in _SHIPPED.items())}
FROM lineitem"""
_SEQ = ("concat_ws('|', " + ", ".join(f'"{n}"' for n in _SHIPPED) + ", l_orderkey, l_linenumber)")


def line_records(spark, d) -> DataFrame:
    """Line items as records of a store without a unique key; seq tells the copies apart."""
    rows = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", F.col("l_partkey").cast("string").alias("part"),
        F.col("l_suppkey").cast("string").alias("supplier"),
        cents("l_quantity").cast("string").alias("quantity"),
        cents("l_extendedprice").cast("string").alias("price"), F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped")).distinct()
    seq = F.concat_ws("|", *_SHIPPED, F.col("l_orderkey").cast("string"),
                      F.col("l_linenumber").cast("string"))
    return rows.withColumn("seq", seq).withColumn("id", F.concat(F.lit("r"), "seq"))


@query("duplicate_diff", f"""
WITH r AS (SELECT *, {_SEQ} AS seq FROM ({_LINES})),
n AS (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY seq DESC) AS rn FROM r),
diffs AS ({' UNION ALL '.join(f'''
  SELECT '{f}' AS field, c.seq, c.l_orderkey || ', ' || c.l_linenumber AS shown, c."{f}" AS copy, k."{f}" AS kept
  FROM n c JOIN n k ON k.l_orderkey = c.l_orderkey AND k.l_linenumber = c.l_linenumber AND k.rn = 1
  WHERE c.rn > 1 AND c."{f}" IS DISTINCT FROM k."{f}"''' for f in _SHIPPED)})
SELECT field, count(*) AS copies_differ, arg_min(shown, seq) AS example_key,
       arg_min(copy, seq) AS example_copy, arg_min(kept, seq) AS example_kept
FROM diffs GROUP BY 1""")
def duplicate_diff(spark, d):
    return sync.duplicate_diff(line_records(spark, d), ["l_orderkey", "l_linenumber"])


# --- sink schema and writes -----------------------------------------------

_SINK = [SinkField("c_custkey", "number"), SinkField("c_name", "text"),
         SinkField("c_mktsegment", "text"), SinkField("c_phone", "text")]


@query("sink_fit", """
SELECT c_custkey, c_name, CAST(NULL AS BIGINT) AS visits, CAST(NULL AS DOUBLE) AS score FROM customer""")
def sink_fit(spark, d):
    """Customers cut to what a target knows, with two number fields created."""
    fitted = sync.fit_to_sink(table(spark, d, "customer"), _SINK, exclude=["c_mktsegment"])
    wider, _ = sync.create_missing(fitted, _SINK, {"visits": 0, "score": 1, "c_custkey": 0})
    return wider


def _status_sql(step: str, times: int) -> str:
    return f"""SELECT '{step}' AS step, o_orderstatus, {times} * count(*) AS n,
       CAST({times} * sum({sql_cents('o_totalprice')}) AS BIGINT) AS total_cents
FROM orders GROUP BY 2"""


@query("sink_writes", " UNION ALL ".join([_status_sql("appended", 2), _status_sql("rebuilt", 1),
                                          _status_sql("replaced", 1)]))
def sink_writes(spark, d):
    """Append twice, rebuild, replace; every table is read back from the shared folder."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus",
                                              cents("o_totalprice").alias("c"))
    root = scratch_path(spark, "sinks")
    for _ in range(2):
        tables.append(orders, f"{root}/appended", ["o_orderstatus"])
    tables.append(orders, f"{root}/rebuilt")
    rebuilt = tables.rebuild(orders, f"{root}/rebuilt")
    # versions whose names don't sort in the order of their writing
    old = orders.withColumn("c", -F.col("c"))
    tables.replace(old, f"{root}/replaced", "9")
    tables.replace(orders, f"{root}/replaced", "10")
    steps = {"appended": spark.read.parquet(f"{root}/appended"), "rebuilt": rebuilt,
             "replaced": tables.current(spark, f"{root}/replaced")}
    parts = [df.groupBy("o_orderstatus").agg(F.count("*").alias("n"), F.sum("c").alias("total_cents"))
             .select(F.lit(step).alias("step"), "o_orderstatus", "n", "total_cents")
             for step, df in steps.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# --- whole syncs ----------------------------------------------------------

def sink_of(df: DataFrame) -> list[SinkField]:
    """Declared fields for the columns of a table."""
    kinds = {"bigint": ("number", 0), "double": ("number", 8)}
    return [SinkField(f.name, *kinds.get(f.dataType.simpleString(), ("text", 0)))
            for f in df.schema.fields]


def _empty(spark, df: DataFrame) -> DataFrame:
    """A copy without records."""
    ids = [T.StructField("id", T.StringType()), T.StructField("seq", T.LongType())]
    return spark.createDataFrame([], T.StructType([*ids, *df.schema.fields]))


def _two_runs(name: str, first: DataFrame, run) -> DataFrame:
    """Sync into an empty copy, then again: what has a key of its own is skipped the
    second time; of records that repeat a key the first meets the last, the others are created again.
    Both runs read the records that the first one has numbered and stored."""
    one = run(first, "first", None)
    again = run(sync.fetched(stored(one.snapshot, "snapshot")), "second", one.records)
    parts = [r.stats.select(F.lit(name).alias("copy"), F.lit(i).alias("run"), "*")
             for i, r in ((1, one), (2, again))]
    return parts[0].unionByName(parts[1])


_AS_OF = "2024-01-31"
_RECENT = f"date >= DATE '{_AS_OF}' - 180"


def _two_runs_sql(name: str, records: str, schema: T.StructType, keys: list[str]) -> str:
    """Counts of both runs: per key the first record in order is compared with the last one."""
    key = " || '|' || ".join(f"lower(trim(coalesce(CAST({k} AS VARCHAR), '')))" for k in keys)
    columns = [*keys, *[c for c in schema.fieldNames() if c not in keys]]
    texts = {f.name for f in schema.fields if isinstance(f.dataType, T.StringType)}

    def shown(side: str, c: str) -> str:
        return f'trim({side}."{c}")' if c in texts else f'{side}."{c}"'

    def order(direction: str) -> str:
        return ", ".join(f'"{c}" {direction}' for c in columns)
    changed = " OR ".join(f'(f."{c}" IS NOT NULL AND {shown("f", c)} IS DISTINCT FROM {shown("l", c)})' for c in columns)
    return f"""
SELECT '{name}' AS copy, run, n AS rows_read, CASE run WHEN 1 THEN n ELSE n - k END AS created,
       CASE run WHEN 1 THEN 0 ELSE u END AS updated, CASE run WHEN 1 THEN 0 ELSE k - u END AS skipped,
       0::BIGINT AS deduplicated, 0::BIGINT AS pruned
FROM (VALUES (1), (2)) AS r(run), (
  WITH o AS (SELECT *, {key} AS _key FROM ({records})),
  p AS (SELECT *, row_number() OVER (PARTITION BY _key ORDER BY {order('ASC NULLS FIRST')}) AS a,
                  row_number() OVER (PARTITION BY _key ORDER BY {order('DESC NULLS LAST')}) AS z FROM o)
  SELECT (SELECT count(*) FROM p) AS n, count(*) AS k, count(*) FILTER ({changed}) AS u
  FROM p f JOIN p l ON l._key = f._key AND l.z = 1 WHERE f.a = 1)"""


_DASHBOARD_RUNS = _two_runs_sql("dashboard", f"SELECT * FROM ({models.mapped_sql(_AS_OF)}) WHERE CAST(date AS DATE) >= DATE '{_AS_OF}' - 180",
                                DASHBOARD, list(dashboard.DASHBOARD_KEYS))
_SOCIAL_RUNS = _two_runs_sql("social", f"SELECT * FROM ({models.POSTS}) WHERE {_RECENT}", SOCIAL_POSTS, list(dashboard.SOCIAL_KEYS))


def _dashboard_runs(items: DataFrame) -> DataFrame:
    mapped = dashboard.dashboard_records(items, _AS_OF)
    return _two_runs("dashboard", _empty(items.sparkSession, mapped), lambda target, run, records: dashboard.sync_dashboard(
        items, target, sink_of(mapped), _AS_OF, records=records, run_id=run))


def _social_runs(posts: DataFrame) -> DataFrame:
    texts = posts.withColumns({c: F.col(c).cast("string") for c in ("date", "post_created_at")})
    return _two_runs("social", _empty(posts.sparkSession, texts), lambda target, run, records: dashboard.sync_social(
        posts, target, sink_of(texts), _AS_OF, records=records, run_id=run))


@query("end_to_end_sync", f"""{_DASHBOARD_RUNS} UNION ALL {_SOCIAL_RUNS} UNION ALL
SELECT 'web', 1, count(*), count(*), 0, 0, 0, count(*) FROM ({models.BREAKDOWN})""")
def end_to_end_sync(spark, d):
    """Dashboard, social and web copies from empty: counts of a first and a second run."""
    # table models: built once, then read by the items and the syncs
    posts = stored(models.social_posts(spark, d), "posts")
    breakdown = stored(models.breakdown_365d(spark, d), "breakdown")
    dash = _dashboard_runs(stored(models.items_of(spark, d, posts, breakdown), "items"))
    soc = _social_runs(posts)
    web = dashboard.sync_web(breakdown, breakdown).stats.select(
        F.lit("web").alias("copy"), F.lit(1).alias("run"), "rows_read", "created",
        F.lit(0).cast("bigint").alias("updated"), F.lit(0).cast("bigint").alias("skipped"),
        F.lit(0).cast("bigint").alias("deduplicated"), F.col("deleted").alias("pruned"))
    return dash.unionByName(soc).unionByName(web)


@query("social_sync", f"SELECT * EXCLUDE (copy) FROM ({_SOCIAL_RUNS})")
def social_sync(spark, d):
    """Recent posts to an empty copy, then again: the second run matches one record of every key."""
    return _social_runs(stored(models.social_posts(spark, d), "posts")).drop("copy")


@query("synced_records", f"""
SELECT 'first:' || (row_number() OVER (ORDER BY {', '.join(f'"{c}" ASC NULLS FIRST' for c in
    [*dashboard.SOCIAL_KEYS, *[c for c in SOCIAL_POSTS.fieldNames() if c not in dashboard.SOCIAL_KEYS]])}) - 1) AS id,
  platform, post_id, content, likes FROM ({models.POSTS}) WHERE {_RECENT}""")
def synced_records(spark, d):
    """The social copy after a first sync: the id of every record is its place in the order."""
    posts = stored(models.social_posts(spark, d), "posts")
    texts = posts.withColumns({c: F.col(c).cast("string") for c in ("date", "post_created_at")})
    done = dashboard.sync_social(posts, _empty(spark, texts), sink_of(texts), _AS_OF, run_id="first")
    return done.snapshot.select("id", "platform", "post_id", "content", "likes")


@query("dashboard_sync", f"""
SELECT count(*) AS rows_read, count(*) AS created, 0::BIGINT AS updated, 0::BIGINT AS skipped,
       0::BIGINT AS deduplicated, 0::BIGINT AS pruned FROM ({models.ITEMS}) WHERE {_RECENT}""")
def dashboard_sync(spark, d):
    """Recent items to an empty dashboard copy: every record is created."""
    items = stored(models.all_items(spark, d), "items")
    mapped = dashboard.dashboard_records(items, _AS_OF)
    return dashboard.sync_dashboard(items, _empty(spark, mapped), sink_of(mapped), _AS_OF).stats


@query("web_sync", f"""
SELECT count(*) AS rows_read, count(*) FILTER (dimension_type <> 'Page') AS deleted, count(*) AS created
FROM ({models.BREAKDOWN})""")
def web_sync(spark, d):
    """The web copy, last written without pages, replaced as a whole."""
    breakdown = stored(models.breakdown_365d(spark, d), "breakdown")
    return dashboard.sync_web(breakdown, breakdown.filter(F.col("dimension_type") != "Page")).stats


@query("list_keys", """
SELECT lower(trim(segments)) AS tags, lower(trim(nation)) AS nation, count(*) AS records FROM (
  SELECT string_agg(c_mktsegment, ',' ORDER BY c_mktsegment) AS segments, CAST(c_nationkey AS VARCHAR) AS nation, c_custkey % 50 AS g
  FROM customer GROUP BY c_nationkey, c_custkey % 50) GROUP BY 1, 2""")
def list_keys(spark, d):
    """Records by a composite key of which one part is a list."""
    records = table(spark, d, "customer").groupBy("c_nationkey", (F.col("c_custkey") % 50).alias("g")).agg(
        F.array_sort(F.collect_list("c_mktsegment")).alias("segments"))
    keyed = records.select(sync.sync_key(records, ["segments", "c_nationkey"]).alias("key"))
    return keyed.groupBy(F.col("key.k0").alias("tags"), F.col("key.k1").alias("nation")).agg(F.count("*").alias("records"))


@query("grid_sync", """
SELECT action, count(*) AS n FROM (
  SELECT CASE WHEN p_type = 'PROMO' THEN 'create' WHEN p_size > 25 THEN 'update' ELSE 'skip' END AS action
  FROM part) GROUP BY 1""")
def grid_sync(spark, d):
    """Parts written as a grid of text cells, read, coerced and matched to a copy."""
    parts = table(spark, d, "part").select(
        "p_partkey", "p_type", "p_size", F.round("p_retailprice", 2).alias("price"))
    path = scratch_path(spark, "grid")
    parts.select(F.col("p_partkey").alias("key"), F.format_number("p_partkey", 0).alias("part"),
                 F.concat(F.lit("$"), F.format_number("price", 2)).alias("price"),
                 F.concat(F.col("p_size").cast("string"), F.lit("%")).alias("share"),
                 F.lit("x").alias("unknown")).write.option("header", True).csv(path)
    grid = tables.read_grid(spark, path)
    fields = [SinkField("part", "number"), SinkField("price", "number", 2),
              SinkField("share", "number", 2)]
    target = parts.filter(F.col("p_type") != "PROMO").select(
        F.concat(F.lit("t"), F.col("p_partkey").cast("string")).alias("id"),
        F.col("p_partkey").alias("seq"), F.col("p_partkey").alias("part"), "price",
        F.when(F.col("p_size") > 25, F.lit(0.0)).otherwise(F.col("p_size") / 100.0).alias("share"))
    ordered = grid.withColumn("source_order", F.col("key").cast("bigint")).drop("key")
    done = dashboard.sync_grid(ordered, target, ["part"], fields)
    return value_counts(done.plan, ["action"])
