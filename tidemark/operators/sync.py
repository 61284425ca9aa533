"""Keeping a downstream copy in step: keys, plan, apply, duplicate report.

A target is a table (id, seq, fields...): ``id`` names the record, ``seq`` is its
place in fetch order.  A source is a table (source_order, fields...).  Both order
columns are unique and required; without them the outcome would be arbitrary.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.cells import SinkField
from ..functions.text import plain_text, squash

_KEY, _WINS, _ALONE = "_sync_key", "_wins", "_alone"
CREATE, UPDATE, SKIP = "create", "update", "skip"
STALE, DUPLICATE = "stale", "duplicate"


def _need(df: DataFrame, cols: Sequence[str], role: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{role} lacks {missing}")


def sync_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """Composite key: each part as text, trimmed and lower-cased, '' when absent."""
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = []
    for i, name in enumerate(keys):
        text = plain_text(F.col(f"`{name}`"), types[name]) if name in types else F.lit(None)
        text = F.coalesce(text.cast("string"), F.lit(""))
        parts.append(F.lower(squash(text)).alias(f"k{i}"))
    return F.struct(*parts)


def split_duplicates(target: DataFrame, keys: Sequence[str], seq: str = "seq",
                     record_id: str = "id") -> tuple[DataFrame, DataFrame]:
    """(kept, extra): the last record of each key in fetch order, and all others.

    A key's winner is a map-side combined maximum; every record is then told by a join on
    its key, of which AQE splits a hot one.
    """
    _need(target, [seq, record_id], "target")
    marked = _with_winner(target.withColumn(_KEY, sync_key(target, keys)),
                          F.max(F.struct(F.col(seq), F.col(record_id))), F.struct(F.col(seq), F.col(record_id)))
    rows = marked.drop(_KEY)
    return rows.filter(_WINS).drop(_WINS), rows.filter(~F.col(_WINS)).drop(_WINS)


def _with_winner(keyed: DataFrame, best: Column, own: Column) -> DataFrame:
    """Rows with a mark on the one of each key that an aggregate picks."""
    winners = keyed.groupBy(_KEY).agg(best.alias("_best"))
    return keyed.join(winners, _KEY).withColumn(_WINS, own == F.col("_best")).drop("_best")


def _changed(fields: Sequence[str], source_types: dict, target_types: dict) -> Column:
    """Some field the source sets shows another trimmed text in the target."""
    tests = []
    for name in fields:
        s = F.col(f"_s.`{name}`")
        t = F.col(f"_t.`{name}`")
        if name not in target_types:
            tests.append(s.isNotNull())
        elif source_types[name] == target_types[name] and \
                isinstance(source_types[name], (T.IntegralType, T.DateType)):
            # one type with one text form per value: no need to write it out
            tests.append(s.isNotNull() & ~s.eqNullSafe(t))
        else:
            new = squash(plain_text(s, source_types[name]))
            old = squash(plain_text(t, target_types[name]))
            tests.append(s.isNotNull() & ~new.eqNullSafe(old))
    return reduce(lambda a, b: a | b, tests) if tests else F.lit(False)


def upsert_plan(source: DataFrame, target: DataFrame, keys: Sequence[str],
                source_order: str = "source_order", seq: str = "seq",
                record_id: str = "id") -> DataFrame:
    """What a sync would do: (action, id, source_order, source fields...).

    One create/update/skip row per source record, one stale row per target key
    the source does not have, one duplicate row per extra target copy.  A key
    that occurs again in the source has used up its match: later records are
    creates.  A NULL in the source never counts as a change.

    Source and target are each read twice: for the winner of every key, and for all rows.
    One full join then meets first records with kept records; a later record and an extra
    copy have a join key of their own, so they meet nothing and no key is hot.
    """
    _need(source, [source_order], "source")
    _need(target, [seq, record_id], "target")
    fields = [c for c in source.columns if c != source_order]
    source_types = {f.name: f.dataType for f in source.schema.fields}
    target_types = {f.name: f.dataType for f in target.schema.fields}

    def keyed(df: DataFrame, best: Column, own: Column, side: str, name: str) -> DataFrame:
        rows = _with_winner(df.withColumn(_KEY, sync_key(df, keys)), best, own)
        alone = F.concat(F.lit(side), F.col(name).cast("string"))
        blank = F.struct(*[F.lit("").alias(f"k{i}") for i in range(len(keys))])
        return rows.withColumns({_KEY: F.when(F.col(_WINS), F.col(_KEY)).otherwise(blank),
                                 _ALONE: F.when(F.col(_WINS), F.lit("")).otherwise(alone)})

    place = F.struct(F.col(seq), F.col(record_id))
    s = keyed(source, F.min(source_order), F.col(source_order), "s", source_order).alias("_s")
    t = keyed(target, F.max(place), place, "t", record_id).alias("_t")
    both = s.join(t, (F.col(f"_s.{_KEY}") == F.col(f"_t.{_KEY}"))
                  & (F.col(f"_s.{_ALONE}") == F.col(f"_t.{_ALONE}")), "full_outer")
    action = (F.when(F.col(f"_s.{source_order}").isNull(), F.when(F.col(f"_t.{_WINS}"), STALE).otherwise(DUPLICATE))
              .when(F.col(f"_t.{record_id}").isNull(), CREATE)
              .when(_changed(fields, source_types, target_types), UPDATE)
              .otherwise(SKIP))
    # The fields pass through without an alias: each alias beside an expression over
    # all fields doubles the constraints the optimizer derives from that expression.
    return both.select(action.alias("action"), F.col(f"_t.{record_id}"),
                       F.col(f"_s.{source_order}"), *[F.col(f"_s.`{c}`") for c in fields])


def apply_plan(target: DataFrame, plan: DataFrame, prune: bool = False, dedupe: bool = False,
               run_id: str = "new", source_order: str = "source_order", seq: str = "seq",
               record_id: str = "id") -> DataFrame:
    """The target after the plan, as one new snapshot.

    Stale records go with ``prune``, extra copies with ``dedupe``.  An update
    writes the fields the source sets and leaves the others.  A created record
    gets the id ``<run_id>:<source_order>`` and no fetch position yet.
    """
    removed = [a for a, on in ((STALE, prune), (DUPLICATE, dedupe)) if on]
    fields = [c for c in target.columns if c not in (record_id, seq)]
    planned = [c for c in fields if c in plan.columns]
    types = {f.name: f.dataType for f in target.schema.fields}

    # one join reads each side once; a created record has no id yet and a join key of its own
    new = F.col(f"_p.{record_id}").isNull()
    joined = target.alias("_t").join(
        plan.alias("_p"), F.struct(F.lit(False).alias("new"), F.col(f"_t.{record_id}").cast("string").alias("key"))
        == F.struct(new.alias("new"), F.when(new, F.col(f"_p.{source_order}").cast("string"))
                    .otherwise(F.col(f"_p.{record_id}").cast("string")).alias("key")), "full_outer")
    action = F.col("_p.action")
    held = F.col(f"_t.{record_id}").isNotNull()
    joined = joined.filter(F.when(held, ~F.coalesce(action, F.lit(SKIP)).isin(removed) if removed else F.lit(True))
                           .otherwise(new))

    def value(name: str) -> Column:
        old = F.col(f"_t.`{name}`")
        if name == record_id:
            return F.when(held, old).otherwise(F.concat(F.lit(f"{run_id}:"), F.col(f"_p.{source_order}").cast("string")))
        if name not in planned:
            return old
        given = F.col(f"_p.`{name}`").cast(types[name])
        return (F.when(~held, given).when(action == UPDATE, F.coalesce(given, old)).otherwise(old))

    return joined.select(*[value(c).alias(c) for c in target.columns])


def fetched(snapshot: DataFrame, seq: str = "seq", record_id: str = "id") -> DataFrame:
    """A snapshot as its store lists it next time: created records stand behind all others.

    Among themselves they stand in the order of their numbers, as numbers: ``new:9`` before ``new:10``.
    """
    last = snapshot.agg(F.coalesce(F.max(seq).cast("bigint"), F.lit(-1).cast("bigint"))).scalar()
    number = F.substring_index(F.col(record_id).cast("string"), ":", -1).try_cast("bigint")
    return snapshot.withColumn(seq, F.coalesce(F.col(seq).cast("bigint"), last + 1 + number))


def sync_stats(plan: DataFrame, prune: bool = False, dedupe: bool = False) -> DataFrame:
    """One row of counts: read, created, updated, skipped, deduplicated, pruned."""
    def count(action: str, on: bool = True) -> Column:
        return F.count_if((F.col("action") == action) & F.lit(on))
    return plan.agg(
        F.count_if(F.col("action").isin(CREATE, UPDATE, SKIP)).alias("rows_read"),
        count(CREATE).alias("created"), count(UPDATE).alias("updated"),
        count(SKIP).alias("skipped"), count(DUPLICATE, dedupe).alias("deduplicated"),
        count(STALE, prune).alias("pruned"))


def replace_stats(target: DataFrame, source: DataFrame) -> DataFrame:
    """Counts of a full replacement: read, deleted, created."""
    deleted = target.agg(F.count("*")).scalar()
    return source.agg(F.count("*").alias("rows_read")).select(
        "rows_read", deleted.alias("deleted"), F.col("rows_read").alias("created"))


def duplicate_diff(target: DataFrame, keys: Sequence[str], seq: str = "seq",
                   record_id: str = "id", ignore: Sequence[str] = ("created_time",)) -> DataFrame:
    """Per field: how many extra copies differ from the kept record, and one example.

    The example is the earliest differing copy.  Only fields that differ
    somewhere are listed.  One map-side combined aggregate finds the keys that have copies and
    their kept record; only their records go on, and AQE splits a hot key among them.
    """
    _need(target, [seq, record_id], "target")
    fields = [c for c in target.columns if c not in (record_id, seq, *ignore)]
    types = {f.name: f.dataType for f in target.schema.fields}
    keyed = target.withColumn(_KEY, sync_key(target, keys))
    whole = F.struct(F.col(seq), F.col(record_id), *[F.col(f"`{c}`") for c in fields])
    kept = (keyed.groupBy(_KEY).agg(F.count("*").alias("_n"), F.max_by(whole, F.struct(F.col(seq), F.col(record_id))).alias("_best"))
            .filter(F.col("_n") > 1).select(_KEY, *[F.col(f"_best.`{c}`") for c in fields]))
    # the kept record is among the copies too; it differs from itself in nothing
    pairs = keyed.withColumn("_first", F.col(seq)).alias("_c").join(
        kept.alias("_k"), F.col(f"_c.{_KEY}") == F.col(f"_k.{_KEY}"))
    diffs = F.array(*[
        F.when(~F.col(f"_c.`{c}`").eqNullSafe(F.col(f"_k.`{c}`")), F.struct(
            F.lit(c).alias("field"),
            plain_text(F.col(f"_c.`{c}`"), types[c]).alias("copy"),
            plain_text(F.col(f"_k.`{c}`"), types[c]).alias("kept")))
        for c in fields])
    differing = pairs.select(
        F.col("_first"),
        F.concat_ws(", ", *[F.col(f"_c.{_KEY}.k{i}") for i in range(len(keys))]).alias("_shown"),
        F.explode(F.array_compact(diffs)).alias("_d"))
    example = F.min_by(F.struct("_shown", "_d.copy", "_d.kept"), F.col("_first"))
    return (differing.groupBy(F.col("_d.field").alias("field"))
            .agg(F.count("*").alias("copies_differ"), example.alias("_e"))
            .select("field", "copies_differ", F.col("_e._shown").alias("example_key"),
                    F.col("_e.copy").alias("example_copy"), F.col("_e.kept").alias("example_kept")))


def duplicate_counts(target: DataFrame, keys: Sequence[str], seq: str = "seq",
                     record_id: str = "id") -> DataFrame:
    """Dry run of a duplicate removal: records now, distinct keys, extra, records after."""
    sizes = target.groupBy(sync_key(target, keys).alias(_KEY)).agg(F.count("*").alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("records_now"),
        F.count("*").alias("distinct_keys"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("extra_copies"),
        F.count("*").alias("records_after"))


def fit_to_sink(df: DataFrame, schema: Sequence[SinkField], exclude: Sequence[str] = (),
                always: Sequence[str] = ()) -> DataFrame:
    """Keep only the columns the target knows, minus an exclude list."""
    known = {f.name for f in schema} | set(always)
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in known and c not in exclude])


def dropped_fields(df: DataFrame, schema: Sequence[SinkField],
                   always: Sequence[str] = ()) -> list[str]:
    """Columns :func:`fit_to_sink` would drop, for the warning."""
    known = {f.name for f in schema} | set(always)
    return sorted(c for c in df.columns if c not in known)


def create_missing(target: DataFrame, schema: Sequence[SinkField],
                   numbers: Mapping[str, int]) -> tuple[DataFrame, list[SinkField]]:
    """Add the number fields the target lacks, empty, with their precision."""
    known = {f.name for f in schema}
    added = [SinkField(name, "number", p) for name, p in numbers.items() if name not in known]
    wider = target.withColumns({f.name: F.lit(None).cast(f.spark_type) for f in added}) \
        if added else target
    return wider, [*schema, *added]
