"""Differences between two snapshots of one table.

Keys match by ``=``: a null key matches nothing, so such a row is an insert on
the newer side and a delete on the older side. With repeated keys, a newer row
is reported once per older row of its key that it differs from.
"""

from __future__ import annotations

import copy

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.names import col, cols, is_comparable, require_columns, require_comparable, spare_name
from daybook.functions.predicates import any_null, none_null, rows_differ
from daybook.operators.align import align_snapshots, align_union
from daybook.operators.joins import join_per_key, repeat_rows
from daybook.spec import DELETE, INSERT, UPDATE, TableSpec

#: The columns of a row's digest, beside its key.
DIGEST = ("digest_high", "digest_low")
#: A key with more pairs of an older and a newer row than this counts as hot.
HOT_PAIRS = 1 << 20
#: The hottest keys that are set apart; the others go the ordinary way, which holds up, too.
HOT_KEYS = 1 << 16
#: Inputs that Spark takes for this much smaller than a skewed partition hold no hot key.
_SURELY_SMALL = 8


class _Pair:
    """Two aligned snapshots with their key and compared columns, checked."""

    def __init__(self, old: DataFrame, new: DataFrame, spec: TableSpec):
        require_columns(old, spec.keys, "the older snapshot")
        self.keys = require_columns(new, spec.keys, "the newer snapshot")
        self.old, self.new = align_snapshots(old, new)
        if spec.compared is None:
            self.compared = [c for c in self.new.columns if c not in self.keys]
        else:
            self.compared = require_columns(new, spec.compared, "the newer snapshot")
        require_comparable(self.new, [*self.keys, *self.compared], "snapshot comparison")
        self.columns = self.new.columns + [c for c in self.old.columns if c not in self.new.columns]
        self.n_old = spare_name("_n_old", old, new)
        self.n_same = spare_name("_n_same", old, new)
        for side in (old, new):
            if spec.op in side.columns:
                raise ValueError(f"a snapshot may not hold a column named {spec.op!r}")

    def part(self, old: DataFrame, new: DataFrame) -> _Pair:
        """The same comparison on some of the rows."""
        other = copy.copy(self)
        other.old, other.new = old, new
        return other

    def old_counts(self) -> DataFrame:
        """Older rows per key; combined before the shuffle."""
        keyed = self.old.where(none_null(cols(self.keys)))
        return keyed.groupBy(*cols(self.keys)).agg(F.count(F.lit(1)).alias(self.n_old))

    def differing(self) -> Column:
        return col(self.n_old) - F.coalesce(col(self.n_same), F.lit(0))

    def with_old_counts(self, how: str) -> DataFrame:
        """Newer rows with the number of older rows of their key and of those equal to them."""
        rows = join_per_key(self.new, self.old_counts(), self.keys, how)
        if not self.compared:
            return rows.withColumn(self.n_same, col(self.n_old))
        image = [*self.keys, *self.compared]
        same = (
            self.old.where(none_null(cols(self.keys)))
            .groupBy(*cols(image))
            .agg(F.count(F.lit(1)).alias(self.n_same))
        )
        matches = [col(k, "n") == col(k, "s") for k in self.keys]
        matches += [col(c, "n").eqNullSafe(col(c, "s")) for c in self.compared]
        # As in join_per_key: keeps Spark from reusing the aggregate's layout.
        matches.append(F.xxhash64(*cols(self.keys, "n")) == F.xxhash64(*cols(self.keys, "s")))
        return rows.alias("n").join(same.alias("s"), matches, "left").select("n.*", col(self.n_same, "s"))


def _tag(df: DataFrame, spec: TableSpec, op: str) -> DataFrame:
    return df.withColumn(spec.op, F.lit(op))


def _without(rows: DataFrame, others: DataFrame, keys: list[str]) -> DataFrame:
    present = others.where(none_null(cols(keys))).select(*cols(keys)).distinct()
    return join_per_key(rows, present, keys, "left_anti")


def inserted(old: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    """Newer rows whose key the older snapshot lacks, tagged ``I``."""
    pair = _Pair(old, new, spec)
    return _tag(_without(pair.new, pair.old, pair.keys), spec, INSERT)


def deleted(old: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    """Older rows whose key the newer snapshot lacks, in full, tagged ``D``."""
    pair = _Pair(old, new, spec)
    own = pair.old.select(*cols(pair.old.columns[: len(old.columns)]))
    return _tag(_without(own, pair.new, pair.keys), spec, DELETE)


def updated(old: DataFrame, new: DataFrame, spec: TableSpec) -> DataFrame:
    """Newer rows that differ from an older row of their key, tagged ``U``."""
    pair = _Pair(old, new, spec)
    changes = _with_hot_keys_apart(pair, spec).where(col(spec.op) == UPDATE)
    return changes.select(*cols([*pair.new.columns, spec.op]))


def change_set(
    old: DataFrame,
    new: DataFrame,
    spec: TableSpec,
    *,
    keys_unique: bool = False,
    null_keys: bool = True,
    repeated_keys: DataFrame | None = None,
) -> DataFrame:
    """All rows inserted, updated or deleted between two snapshots, with ``op``.

    The rows are the same whichever way is taken. By default the result holds up
    when a key or the null key has any number of rows. Both sides are exchanged once,
    by key, and windows count per key and per image what would else be row pairs. Hot
    keys, found by a count over the key columns, are set apart: theirs is the form that
    joins with counts, in which every join has a left side that AQE may split. Rows with
    a null key are not exchanged at all.

    ``keys_unique=True`` is for snapshots known to hold one row per non-null key,
    such as cleaned dumps: one full outer join, each side exchanged once. Rows with a
    null key stay out of it, as Spark would put them all into one task;
    ``null_keys=False`` says there are none, which saves looking for them.

    ``repeated_keys`` is for snapshots with few repeated keys: a frame that holds
    all of them, which keeps those rows out of the full outer join (Spark broadcasts
    it if it is small). Rows with a null key then skip every join.
    """
    pair = _Pair(old, new, spec)
    if keys_unique:
        return _by_full_join_of_keyed(pair, spec) if null_keys else _by_full_join(pair, spec)
    if repeated_keys is None:
        return _with_hot_keys_apart(pair, spec)
    return _by_full_join_but_for(pair, spec, repeated_keys)


def _hot_keys(pair: _Pair) -> DataFrame | None:
    """The hottest keys, ``HOT_KEYS`` at most; None where the inputs are too small to hold any.

    Hot are keys whose rows exceed what AQE takes for a skewed partition, and keys with
    very many pairs. Sizes are estimates: a wrong one costs time, never rows. The choice
    depends on the rows alone, as two branches of the plan have to agree on it.
    """
    spark = pair.new.sparkSession
    given = spark.conf.get("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes")
    skewed = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given)
    sizes = [side._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() for side in (pair.old, pair.new)]
    if sum(int(str(n)) for n in sizes) < skewed // _SURELY_SMALL:
        return None
    most = skewed // pair.new._jdf.schema().defaultSize()
    keys, is_old = cols(pair.keys), spare_name("_is_old", pair.old, pair.new)
    both = [side.select(*keys, F.lit(n).cast("long").alias(is_old)) for n, side in enumerate((pair.new, pair.old))]
    n_old, n_all = F.sum(col(is_old)), F.count(F.lit(1))
    rows, pairs = spare_name("_rows", pair.old, pair.new), spare_name("_pairs", pair.old, pair.new)
    counts = (
        both[0].unionByName(both[1]).where(none_null(keys)).groupBy(*keys)
        .agg(n_all.alias(rows), (n_old.cast("double") * (n_all - n_old)).alias(pairs))
        .where((col(rows) > most) | (col(pairs) > HOT_PAIRS))
    )
    hottest = counts.orderBy(col(pairs).desc(), col(rows).desc(), *keys).limit(HOT_KEYS)
    return hottest.select(*keys)


def _with_hot_keys_apart(pair: _Pair, spec: TableSpec) -> DataFrame:
    keyed, keyless = none_null(cols(pair.keys)), any_null(cols(pair.keys))
    old, new, hot = pair.old.where(keyed), pair.new.where(keyed), _hot_keys(pair)
    parts = [_tag(pair.new.where(keyless), spec, INSERT), _tag(pair.old.where(keyless), spec, DELETE)]
    if hot is None:
        parts.append(_by_window(pair.part(old, new), spec))
    else:
        # At most HOT_KEYS keys.
        apart = F.broadcast(hot)

        def side(rows: DataFrame, how: str) -> DataFrame:
            return rows.join(apart, pair.keys, how).select(*cols(rows.columns))

        parts.append(_by_window(pair.part(side(old, "left_anti"), side(new, "left_anti")), spec))
        parts.append(_by_counts(pair.part(side(old, "left_semi"), side(new, "left_semi")), spec))
    return align_union(*parts).select(*cols([*pair.columns, spec.op]))


def _by_window(pair: _Pair, spec: TableSpec) -> DataFrame:
    """Both sides exchanged once by key; a key's rows are counted where they meet."""
    names = [spare_name(n, pair.old, pair.new) for n in ("_is_old", "_n_old", "_n_all", "_n_same", "_times", "_nth")]
    is_old, n_old, n_all, n_same, times, nth = names
    both = align_union(
        pair.new.withColumn(is_old, F.lit(0).cast("long")), pair.old.withColumn(is_old, F.lit(1).cast("long"))
    )
    per_key = Window.partitionBy(*cols(pair.keys))
    per_image = Window.partitionBy(*cols([*pair.keys, *pair.compared]))
    counted = (
        both.withColumn(n_same, F.sum(col(is_old)).over(per_image))
        .withColumn(n_old, F.sum(col(is_old)).over(per_key))
        .withColumn(n_all, F.count(F.lit(1)).over(per_key))
    )
    gone, fresh = col(n_old) == col(n_all), col(n_old) == 0
    of_old = F.when(gone, 1).otherwise(0)
    of_new = F.when(fresh, 1).otherwise(col(n_old) - col(n_same))
    op = F.when(col(is_old) == 1, DELETE).when(fresh, INSERT).otherwise(UPDATE)
    changed = counted.withColumn(times, F.when(col(is_old) == 1, of_old).otherwise(of_new).cast("long"))
    changed = changed.where(col(times) > 0).withColumn(spec.op, op)
    unfolded = changed.withColumn(nth, F.explode(F.sequence(F.lit(1).cast("long"), col(times))))
    return unfolded.select(*cols([*pair.columns, spec.op]))


def _by_full_join_but_for(pair: _Pair, spec: TableSpec, repeated: DataFrame) -> DataFrame:
    keys = pair.keys
    few = repeated.select(*cols(require_columns(repeated, keys, "the repeated keys"))).toDF(*keys)

    def split(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
        keyed = rows.where(none_null(cols(keys)))
        kinds = [keyed.join(few, keys, how).select(*cols(rows.columns)) for how in ("left_anti", "left_semi")]
        return kinds[0], kinds[1], rows.where(any_null(cols(keys)))

    old_once, old_often, old_keyless = split(pair.old)
    new_once, new_often, new_keyless = split(pair.new)
    changes = align_union(
        _by_full_join(pair.part(old_once, new_once), spec),
        _by_counts(pair.part(old_often, new_often), spec),
        _tag(new_keyless, spec, INSERT),
        _tag(old_keyless, spec, DELETE),
    )
    return changes.select(*cols([*pair.columns, spec.op]))


def _by_full_join_of_keyed(pair: _Pair, spec: TableSpec) -> DataFrame:
    if not any(side.schema[k].nullable for side in (pair.old, pair.new) for k in pair.keys):
        return _by_full_join(pair, spec)
    keyed, keyless = none_null(cols(pair.keys)), any_null(cols(pair.keys))
    changes = align_union(
        _by_full_join(pair.part(pair.old.where(keyed), pair.new.where(keyed)), spec),
        _tag(pair.new.where(keyless), spec, INSERT),
        _tag(pair.old.where(keyless), spec, DELETE),
    )
    return changes.select(*cols([*pair.columns, spec.op]))


def _by_counts(pair: _Pair, spec: TableSpec) -> DataFrame:
    fresh = col(pair.n_old).isNull()
    times = F.when(fresh, 1).otherwise(pair.differing())
    rows = pair.with_old_counts("left").where(times > 0)
    op = F.when(fresh, INSERT).otherwise(UPDATE)
    current = repeat_rows(rows.withColumn(spec.op, op), times)
    gone = _tag(_without(pair.old, pair.new, pair.keys), spec, DELETE)
    changes = align_union(current.select(*cols([*pair.new.columns, spec.op])), gone)
    return changes.select(*cols([*pair.columns, spec.op]))


def _by_full_join(pair: _Pair, spec: TableSpec) -> DataFrame:
    # Sides are told apart by markers of their own, never by a null key.
    here = spare_name("_here", pair.old, pair.new)
    p = pair.old.withColumn(here, F.lit(True)).alias("p")
    c = pair.new.withColumn(here, F.lit(True)).alias("c")
    joined = p.join(c, [col(k, "p") == col(k, "c") for k in pair.keys], "full_outer")

    differs = rows_differ(cols(pair.compared, "p"), cols(pair.compared, "c"))
    gone = col(here, "c").isNull()
    op = F.when(col(here, "p").isNull(), INSERT).when(gone, DELETE).when(differs, UPDATE)
    images = []
    for name in pair.columns:
        before = col(name, "p") if name in pair.old.columns else F.lit(None)
        after = col(name, "c") if name in pair.new.columns else F.lit(None)
        images.append(F.when(gone, before).otherwise(after).alias(name))
    return joined.select(*images, op.alias(spec.op)).where(col(spec.op).isNotNull())


def row_digests(rows: DataFrame, spec: TableSpec) -> DataFrame | None:
    """Each row's key and a digest of 128 bits of its compared columns, in ``DIGEST``.

    None if a compared column is nested, as hashes pass over nulls, which enter by their
    place, and within a nested value they have none; or if it is of a type without equality.
    """
    keys = require_columns(rows, spec.keys, "the snapshot")
    if spec.compared is None:
        image = [c for c in rows.columns if c not in keys]
    else:
        image = require_columns(rows, spec.compared, "the snapshot")
    types = [rows.schema[c].dataType for c in image]
    if any(isinstance(t, (T.ArrayType, T.StructType)) or not is_comparable(t) for t in types):
        return None
    if set(DIGEST) & {c.lower() for c in keys}:
        raise ValueError(f"a key may not be named like the digest's columns {DIGEST}")
    parts = [*cols(image), *[c.isNull() for c in cols(image)]]
    halves = [F.xxhash64(F.lit(k), *parts).alias(n) for k, n in enumerate(DIGEST)]
    return rows.select(*cols(keys), *halves)


def touched_keys(old_digests: DataFrame, new_digests: DataFrame, spec: TableSpec) -> DataFrame:
    """Keys that are new, gone or of another digest, with ``I``, ``D`` or ``U``; from :func:`row_digests`."""
    keys = list(spec.keys)
    here = spare_name("_here", old_digests, new_digests)
    p = old_digests.toDF(*keys, *DIGEST).withColumn(here, F.lit(True)).alias("p")
    c = new_digests.toDF(*keys, *DIGEST).withColumn(here, F.lit(True)).alias("c")
    joined = p.join(c, [col(k, "p") == col(k, "c") for k in keys], "full_outer")
    differs = rows_differ(cols(DIGEST, "p"), cols(DIGEST, "c"))
    op = F.when(col(here, "p").isNull(), INSERT).when(col(here, "c").isNull(), DELETE).when(differs, UPDATE)
    either = [F.coalesce(col(k, "p"), col(k, "c")).alias(k) for k in keys]
    return joined.select(*either, op.alias(spec.op)).where(col(spec.op).isNotNull())


def change_set_by_digests(
    old: DataFrame, new: DataFrame, spec: TableSpec, touched: DataFrame, *, few: bool = False
) -> DataFrame:
    """:func:`change_set` of snapshots with unique keys, none null, given their :func:`touched_keys`.

    Whole rows are fetched for those keys alone, and those of another digest are compared
    by value. ``few=True`` says that the keys have been counted and are few enough to be
    sent to every task: then no row moves that did not change. Else Spark decides.
    """
    pair = _Pair(old, new, spec)
    touched = touched.toDF(*pair.keys, spec.op)

    def fetched(rows: DataFrame, *ops: str) -> DataFrame:
        wanted = touched.where(col(spec.op).isin(*ops)).select(*cols(pair.keys))
        wanted = F.broadcast(wanted) if few else wanted
        return rows.join(wanted, pair.keys, "left_semi").select(*cols(rows.columns))

    return _by_full_join(pair.part(fetched(pair.old, UPDATE, DELETE), fetched(pair.new, UPDATE, INSERT)), spec)


def change_counts(changes: DataFrame, spec: TableSpec, *, per_day: bool = False) -> DataFrame:
    """Rows per operation, or per day and operation of a change log."""
    wanted = [spec.day, spec.op] if per_day else [spec.op]
    by = require_columns(changes, wanted, "the change set")
    return changes.groupBy(*cols(by)).agg(F.count(F.lit(1)).alias("count"))

