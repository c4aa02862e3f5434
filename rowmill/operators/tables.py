"""Insert, update, delete and keyed batch changes of Spark tables, each with the number of rows it touched.

Parquet tables have no row-level changes, so update and delete write a new snapshot next to the current one and then
point the table at it; readers that already started keep the old files. A partitioned table is changed partition by
partition: only those that hold a matching row are rewritten. Partition a table by what its changes filter on.

Counts come out of the writing job itself (an observed metric in its last stage), not out of a second scan.
One change at a time per table: all of them, ``insert`` included, take the table's marker file first and refuse if it is
there. Files that other writers added since the scan are noticed before the swap, and the change is refused.

The swap of an unpartitioned table is one catalog call; a partitioned one takes a call per rewritten partition. What is
to be done is written to the table's folder before the first call, and a change that was broken off in between is
finished by the next one (or by :func:`recover`, which also removes the marker that a lost process left).

``DROP TABLE`` removes the current snapshot at most; :func:`drop` removes the table's folder as well.
"""

from __future__ import annotations

import json
import posixpath
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager, nullcontext
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

from ..shared import settle, stored
from .bloom import might_hold
from .constraints import ConstraintViolation, check_constraints
from .files import SNAPSHOT as _SNAPSHOT, Files as _Files
from .reads import Params, filter_rows, over_view

#: The column that holds the bucket of a row's key, in tables created with buckets.
BUCKET = "key_bucket"
_BUCKET_KEY, _BUCKET_COUNT = "rowmill.bucket.key", "rowmill.bucket.count"
#: Key types of buckets: those whose equal values have equal hashes.
_HASHABLE = (T.IntegralType, T.DecimalType, T.DateType, T.TimestampType, T.TimestampNTZType, T.BooleanType, T.BinaryType)
_HITS = "__hits"
_MARKER, _INTENT = "/_change-in-progress", "/_intent.json"
#: File formats whose tables update and delete can write anew.
_REWRITABLE = ("parquet", "orc", "csv", "json")
# What partition folders hold for NULL, and the characters their names escape as %XX.
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_ESCAPED = set("\"#%'*/:=?\\{[]^\x7f") | {chr(code) for code in range(1, 32)}


# --- the four changes ---------------------------------------------------------------------------------------------


def insert(
    table: str,
    df: DataFrame,
    create: bool = False,
    partition_by: Sequence[str] = (),
    location: str | None = None,
    not_null: Sequence[str] = (),
    key: Sequence[str] = (),
    buckets: int | None = None,
) -> int:
    """Append ``df`` by column name; columns it lacks take their default or NULL. Returns the number of rows.

    ``create`` makes the table first if it is absent (parquet, partitioned by ``partition_by``). With ``not_null`` or
    ``key`` the batch is checked first and refused whole (:class:`ConstraintViolation`) if any row breaks them. The
    insert commits as one: a failed job leaves the table as it was.

    A table created with ``buckets`` is partitioned by a further column ``key_bucket`` as well, a hash of its ``key``
    modulo that number. Inserts fill it, and changes that name the whole key read and rewrite the key's bucket alone;
    take as many buckets as make one a few hundred megabytes. All rows must come in through these functions.
    """
    spark = df.sparkSession
    if create:
        _create(spark, table, df, partition_by, location, key, buckets)
    target = _describe(spark, table)
    if target.buckets:
        df = df.drop(BUCKET).withColumn(BUCKET, target.buckets.of(spark.table(table), df.columns))
    with _changing(spark, target) if target.location else nullcontext():
        if not_null or key:
            df = stored(df, "batch")  # what is checked is what is inserted
            violations = check_constraints(table, df, not_null, key)
            examples = violations.take(5)
            if examples:
                raise ConstraintViolation(f"insert into {table} refused, for example: {examples}", violations)
        present = [p for p in target.partitions if p in df.columns]
        # gathers the rows of a partition into few files; an oversized one is split again, unlike with repartition
        rows = df.hint("rebalance", *present) if present else df
        counted = Observation()
        columns = ", ".join(_name(c) for c in df.columns)
        over_view(
            rows.observe(counted, F.count(F.lit(1)).alias("rows")),
            f"INSERT INTO {table} ({columns}) SELECT {columns} FROM ",
        )
    return counted.get["rows"]


def update(
    table: str,
    assignments: dict[str, object],
    where: str | Column | None = None,
    params: Params = None,
    spark: SparkSession | None = None,
) -> int:
    """Set columns in the rows where ``where`` is true (all rows without it); returns how many rows matched.

    A text value is a SQL expression over the old row (``"salary * 1.1"``, ``"'a text'"``), a Column is used as it is,
    anything else is a constant. Results are cast to the column's type and must fit it.
    """
    if not assignments:
        raise ValueError("update needs at least one column to set")
    spark = spark or SparkSession.active()
    target = _describe(spark, table, to_change=True)
    df = spark.table(table)
    new = {}
    for name, value in assignments.items():
        column = _resolve(df, name)
        if target.buckets and column == BUCKET:
            raise ValueError(f"{BUCKET} follows from the key and cannot be set")
        expression = F.expr(value) if isinstance(value, str) else value if isinstance(value, Column) else F.lit(value)
        new[column] = _fitted(expression, df.schema[column])
    _move_bucket(target, df, new)

    def assigned(hit: Column) -> list[Column]:
        # one select, so that every expression sees the old row
        return [_assigned(c, hit, new) for c in df.columns]

    return _change(
        spark,
        target,
        matching=lambda rows: _in_bucket(target, filter_rows(rows, where, params)),
        moved={p: new[p] for p in target.partitions if p in new},
        marked=lambda rows: _marked(rows, where, params),
        result=lambda rows: rows.select(*assigned(F.col(_HITS) > 0)),
        look_first=where is not None,
    )


def delete(
    table: str, where: str | Column | None = None, params: Params = None, spark: SparkSession | None = None
) -> int:
    """Remove the rows where ``where`` is true (all rows without it); returns how many were removed.

    Rows for which the predicate is NULL stay.
    """
    spark = spark or SparkSession.active()
    target = _describe(spark, table, to_change=True)
    return _change(
        spark,
        target,
        matching=lambda rows: _in_bucket(target, filter_rows(rows, where, params)),
        moved={},
        marked=lambda rows: _marked(rows, where, params),
        result=lambda rows: rows.where(F.col(_HITS) == 0).drop(_HITS),
        look_first=where is not None,
    )


def execute_many(
    table: str, kind: str, params_df: DataFrame, key: Sequence[str] = (), ordinal: str | None = None
) -> int:
    """One keyed change for many parameter sets, the rows of ``params_df``; returns the sum of the touched rows.

    - ``insert``: every set is a row to append.
    - ``update``: each set assigns its other columns, as constants, to the rows with its ``key``. ``ordinal`` names
      the column with the order of the sets; the last set of a key wins, and every set counts the rows it matched.
      An ordinal that is NULL or repeated within a key is refused.
    - ``delete``: each set removes the rows with its ``key``; a row can be removed once.

    Sets with a NULL in the key match nothing. The sets are reduced to one per key by a map-side pre-aggregation, so a
    key that most sets name is no bottleneck, and the table is only shuffled when they exceed the broadcast threshold.
    """
    spark = params_df.sparkSession
    if kind == "insert":
        return insert(table, params_df)
    if kind not in ("update", "delete"):
        raise ValueError(f"unknown kind {kind!r}, expected insert, update or delete")
    if not key:
        raise ValueError("a keyed change needs key columns")
    target = _describe(spark, table, to_change=True)
    df = spark.table(table)
    values = [c for c in params_df.columns if c not in key and c != ordinal] if kind == "update" else []
    if kind == "update":
        if not values:
            raise ValueError("update needs at least one column to set besides the key")
        if ordinal is None:
            raise ValueError("update needs an ordinal column, the order in which the sets apply")
    new_names = {_resolve(df, c): c for c in values}
    places = [F.col(c).alias(f"__k{i}") for i, c in enumerate(key)]
    given = params_df.dropna(subset=list(key))
    last = []
    if values:
        typed = [F.col(_name(c)).cast(df.schema[column].dataType).alias(c) for column, c in new_names.items()]
        last = [F.max_by(F.struct(*typed), F.col(_name(ordinal))).alias("__last")]
    sets, small = settle(given.groupBy(*places).agg(F.count(F.lit(1)).alias("__sets"), *last))
    if values:
        _refuse_unordered(given, sets, places, ordinal)
    same = reduce(lambda a, b: a & b, [F.col(_name(c)) == F.col(f"__k{i}") for i, c in enumerate(key)])
    if target.buckets and (bucket := target.buckets.of_sets(df, sets, key)) is not None:
        sets, same = sets.withColumn("__bucket", bucket), same & (F.col(BUCKET) == F.col("__bucket"))
        sets = F.broadcast(sets) if small else sets
    new = {c: _fitted(F.col(f"__last.{_name(p)}"), df.schema[c]) for c, p in new_names.items()}
    _move_bucket(target, df, new)
    moved = {p: new[p] for p in target.partitions if p in new}
    hit = F.col("__sets").isNotNull()
    counted = F.coalesce("__sets", F.lit(0)) if kind == "update" else hit.cast("long")
    no_match = [F.lit(None).cast(field.dataType).alias(field.name) for field in sets.schema]
    may_match = None if small else might_hold(sets, _comparable(df, sets, key))

    def marked(rows: DataFrame) -> DataFrame:
        if may_match is None:
            return rows.join(sets, same, "left").withColumn(_HITS, counted)
        # only rows whose key the filter knows are shuffled to meet the sets
        met = rows.where(may_match).join(sets, same, "left")
        return met.unionByName(rows.where(~may_match).select("*", *no_match)).withColumn(_HITS, counted)

    def updated(rows: DataFrame) -> DataFrame:
        return rows.select(*[_assigned(c, hit, new) for c in df.columns])

    return _change(
        spark,
        target,
        # without new partitions the filter tells well enough where matches lie: a partition too many is only rewritten
        matching=lambda rows: rows.where(may_match) if may_match is not None and not moved else rows.join(sets, same),
        moved=moved,
        marked=marked,
        result=updated if kind == "update" else lambda rows: rows.where(~hit).select(*df.columns),
    )


def _refuse_unordered(given: DataFrame, sets: DataFrame, places: list[Column], ordinal: str) -> None:
    """Refuse sets whose order is not clear. Only where keys are named more than once are their places compared."""
    order = F.col(_name(ordinal))
    unclear = given.where(order.isNull())
    if not sets.where("__sets > 1").isEmpty():
        unclear = given.groupBy(*places, order.alias("__place")).count().where("`count` > 1 OR __place IS NULL")
    else:
        unclear = unclear.select(*places)
    found = unclear.first()
    if found:
        raise ValueError(f"{ordinal} must number the sets of a key, but is NULL or repeated for {tuple(found)[: len(places)]}")


def _comparable(df: DataFrame, sets: DataFrame, key: Sequence[str]) -> list[tuple[Column, Column]] | None:
    """Key columns of the table and of the sets in a common type in which equal values have equal hashes, or none."""
    pairs = []
    for i, c in enumerate(key):
        kinds = (df.schema[_resolve(df, c)].dataType, sets.schema[f"__k{i}"].dataType)
        whole = all(isinstance(kind, T.IntegralType) for kind in kinds)
        if not whole and (kinds[0] != kinds[1] or not _hashable(kinds[0])):
            return None
        pair = (F.col(_name(c)), F.col(f"__k{i}"))
        pairs.append(tuple(column.cast("bigint") for column in pair) if whole else pair)
    return pairs


def vacuum(table: str, spark: SparkSession | None = None) -> int:
    """Delete the files that the table no longer points at, the first snapshot's too; returns how many folders.

    Run it without readers; a change in progress makes it fail.
    """
    spark = spark or SparkSession.active()
    with _changing(spark, _describe(spark, table)):
        target = _describe(spark, table)
        files = _Files(spark, target.root)
        live = {posixpath.dirname(unquote(urlparse(name).path)) for name in spark.table(table).inputFiles()}
        live.add(files.plain(target.location))
        removed = 0
        for folder in files.snapshots(target.root):
            stale = [leaf for leaf in files.leaves(folder) if leaf not in live]
            if not any(name == folder or name.startswith(folder + "/") for name in live):
                stale = [folder]
            for leaf in stale:
                files.delete(leaf)
            removed += len(stale)
        if target.root != target.location:
            # what was there before the first change lies in the root itself
            root = files.plain(target.root)
            for leaf in files.leaves(target.root):
                if leaf != root and not leaf.startswith(root + _SNAPSHOT) and leaf not in live:
                    files.delete(leaf)
                    removed += 1
            own = files.data_files(target.root) if root not in live else []
            for name in own:
                files.delete(name)
            removed += bool(own)
    return removed


def drop(table: str, spark: SparkSession | None = None) -> None:
    """Remove the table and its folder with all snapshots, so that the name can be used again."""
    spark = spark or SparkSession.active()
    target = _describe(spark, table)
    with _changing(spark, target):
        spark.sql(f"DROP TABLE {table}")
        _Files(spark, target.root).delete(target.root)


def recover(table: str, spark: SparkSession | None = None) -> bool:
    """After a process was lost in the middle of a change: finish its swap if that had begun, else forget the change.

    Call it only when no change is running; returns whether a swap was finished.
    """
    spark = spark or SparkSession.active()
    target = _describe(spark, table)
    finished = _finish(spark, target)
    _Files(spark, target.root).delete(target.root + _MARKER)
    return finished


# --- how a change is carried out ----------------------------------------------------------------------------------


@dataclass
class _Buckets:
    """The hash of a key's columns, modulo a number, that a table is partitioned by."""

    key: list[str]
    count: int

    def _number(self, columns: list[Column]) -> Column:
        return F.pmod(F.xxhash64(*columns), F.lit(self.count)).cast("int")

    def of(self, table: DataFrame, present: Sequence[str], new: dict[str, Column] | None = None) -> Column:
        """The bucket of rows with these columns, by the table's types; ``new`` values take the place of old ones."""
        values = {c.lower(): F.col(_name(c)) for c in present} | {c.lower(): v for c, v in (new or {}).items()}
        return self._number([values.get(c.lower(), F.lit(None)).cast(table.schema[c].dataType) for c in self.key])

    def of_sets(self, table: DataFrame, sets: DataFrame, key: Sequence[str]) -> Column | None:
        """The bucket of parameter sets, if their key says it for sure."""
        places = {_resolve(table, c): f"__k{i}" for i, c in enumerate(key)}
        if not set(self.key) <= set(places) or any(sets.schema[places[c]].dataType != table.schema[c].dataType for c in self.key):
            return None
        return self._number([F.col(places[c]) for c in self.key])


def _hashable(kind: T.DataType) -> bool:
    return isinstance(kind, _HASHABLE) or kind == T.StringType()


def _in_bucket(target: _Target, rows: DataFrame) -> DataFrame:
    """Rows of a filter, with what follows from it for the bucket: where it fixes the key, one partition is left.

    The condition holds for every row; Spark puts a key's constant into it and prunes by the result.
    """
    return rows.where(F.col(BUCKET) == target.buckets.of(rows, target.buckets.key)) if target.buckets else rows


def _move_bucket(target: _Target, table: DataFrame, new: dict[str, Column]) -> None:
    if target.buckets and set(new) & set(target.buckets.key):
        new[BUCKET] = target.buckets.of(table, target.buckets.key, new)


@dataclass
class _Target:
    name: str
    provider: str
    location: str
    partitions: list[str]
    options: dict[str, str]
    buckets: _Buckets | None = None

    @property
    def root(self) -> str:
        return self.location.split(_SNAPSHOT)[0]


def _describe(spark: SparkSession, table: str, to_change: bool = False) -> _Target:
    facts = json.loads(spark.sql(f"DESCRIBE TABLE EXTENDED {table} AS JSON").first()[0])
    partitions = facts.get("partition_columns") or []
    if to_change and "location" not in facts:
        raise ValueError(f"{table} is no table with files of its own")
    if to_change and facts.get("bucket_columns"):
        raise ValueError(f"{table} is bucketed; changing bucketed tables is not supported")
    if to_change and partitions and facts.get("partition_provider") != "Catalog":
        raise ValueError(f"the partitions of {table} are not in the catalog, so they cannot be pointed elsewhere")
    if to_change and facts.get("provider") not in _REWRITABLE:
        raise ValueError(f"{table} is stored as {facts.get('provider')}; only {', '.join(_REWRITABLE)} can be changed")
    options = {k: v for k, v in (facts.get("storage_properties") or {}).items() if k not in ("path", "serialization.format")}
    known = facts.get("table_properties") or {}
    buckets = _Buckets(json.loads(known[_BUCKET_KEY]), int(known[_BUCKET_COUNT])) if _BUCKET_KEY in known else None
    return _Target(table, facts.get("provider", ""), facts.get("location", ""), partitions, options, buckets)


@contextmanager
def _changing(spark: SparkSession, target: _Target) -> Iterator[None]:
    """Hold the table's marker; a swap that an earlier change left half done is finished first."""
    if not target.location:
        raise ValueError(f"{target.name} is no table with files of its own")
    files = _Files(spark, target.root)
    if not files.create(target.root + _MARKER, target.name):
        raise RuntimeError(f"another change of {target.name} is running; if its process was lost, call recover()")
    try:
        _finish(spark, target)
        yield
    finally:
        files.delete(target.root + _MARKER)


def _fitted(value: Column, field) -> Column:
    """The value in the column's type; a text that is too long for a char or varchar column fails as on insert."""
    value = value.cast(field.dataType)
    kind = field.metadata.get("__CHAR_VARCHAR_TYPE_STRING", "")
    if not kind:
        return value
    length = int(kind[kind.index("(") + 1 : -1])
    value = F.rpad(value, F.greatest(F.length(value), F.lit(length)), F.lit(" ")) if kind.startswith("char(") else value
    # blanks beyond the length are cut off, as on insert
    short = F.when(F.length(value) > length, F.rpad(F.rtrim(value), F.greatest(F.length(F.rtrim(value)), F.lit(length)), F.lit(" "))).otherwise(value)
    problem = F.raise_error(F.concat(F.lit(f"a value of column {field.name} is longer than {kind}: "), value)).cast("string")
    return F.when(F.length(short) > length, problem).otherwise(short)


def _create(
    spark: SparkSession,
    table: str,
    df: DataFrame,
    partition_by: Sequence[str],
    location: str | None,
    key: Sequence[str],
    buckets: int | None,
) -> None:
    fields = [f"{_name(field.name)} {field.dataType.simpleString()}" for field in df.schema if not (buckets and field.name == BUCKET)]
    partition_by, properties = list(partition_by), ""
    if buckets:
        key = [_resolve(df, c) for c in key]
        if not key or any(not _hashable(df.schema[c].dataType) for c in key):
            raise ValueError("buckets need a key of whole numbers, decimals, text, dates, times or bytes")
        fields.append(f"{_name(BUCKET)} int")
        partition_by.append(BUCKET)
        properties = f" TBLPROPERTIES ({_text(_BUCKET_KEY)} = {_text(json.dumps(key))}, {_text(_BUCKET_COUNT)} = '{buckets}')"
    partitioned = f" PARTITIONED BY ({', '.join(_name(c) for c in partition_by)})" if partition_by else ""
    at = f" LOCATION {_text(location)}" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(fields)}) USING parquet{partitioned}{at}{properties}")


def _assigned(column: str, hit: Column, new: dict[str, Column]) -> Column:
    old = F.col(_name(column))
    return F.when(hit, new[column]).otherwise(old).alias(column) if column in new else old


def _marked(rows: DataFrame, where: str | Column | None, params: Params) -> DataFrame:
    """All rows, with 1 in the hit column where the predicate is true and 0 where it is false or NULL."""
    if where is None:
        return rows.withColumn(_HITS, F.lit(1))
    if isinstance(where, Column) or not params:
        condition = F.expr(where) if isinstance(where, str) else where
        return rows.withColumn(_HITS, F.coalesce(condition, F.lit(False)).cast("int"))
    return over_view(rows, f"SELECT *, CAST(coalesce(({where}), false) AS INT) AS {_HITS} FROM ", params)


def _change(
    spark: SparkSession,
    target: _Target,
    matching: Callable[[DataFrame], DataFrame],
    moved: dict[str, Column],
    marked: Callable[[DataFrame], DataFrame],
    result: Callable[[DataFrame], DataFrame],
    look_first: bool = False,
) -> int:
    """Write the changed snapshot, point the table at it and return the number of hits.

    ``matching`` gives the rows concerned in a form whose filter reaches the scan, ``marked`` all rows with the number
    of hits in a column, ``result`` the rows to keep from those, ``moved`` new values of partition columns. With
    ``look_first`` an unpartitioned table without a match is found by a filtered scan and not rewritten.
    """
    with _changing(spark, target):
        target = _describe(spark, target.name, to_change=True)  # a swap that was left half done may have moved it
        rows = spark.table(target.name)
        touched = []
        if target.partitions:
            touched = _touched(matching(rows), target, moved)
            if not touched:
                return 0
            rows = rows.where(_in_partitions(target, touched))
        scanned = set(rows.inputFiles())
        if not target.partitions and look_first and matching(rows).isEmpty():
            return 0
        counted = Observation()
        observed = marked(rows).observe(counted, F.coalesce(F.sum(_HITS), F.lit(0)).alias("hits"))
        folder = f"{target.root}{_SNAPSHOT}{uuid.uuid4().hex}"
        writer = result(observed).write.format(target.provider).options(**target.options)
        writer.partitionBy(*target.partitions).save(folder)
        hits = counted.get["hits"]
        if hits == 0:
            _Files(spark, target.root).delete(folder)
            return 0
        spark.catalog.refreshTable(target.name)
        now = spark.table(target.name)
        if target.partitions:
            now = now.where(_in_partitions(target, touched))
        if _describe(spark, target.name).location != target.location or set(now.inputFiles()) != scanned:
            _Files(spark, target.root).delete(folder)
            raise RuntimeError(f"{target.name} was written to meanwhile; the change was not applied")
        _point_at(spark, target, folder, touched)
    return hits


def _touched(hits: DataFrame, target: _Target, moved: dict[str, Column]) -> list:
    """The partitions that matching rows lie in or move to: typed values, then the same values as text.

    At most as many rows as the table has partitions, which the driver holds anyway to plan any scan.
    """
    now = hits.select(*[F.col(_name(p)) for p in target.partitions])
    if moved:
        now = now.unionAll(
            # empty text is stored in the partition of NULL
            hits.select(
                *[
                    F.when(moved[p].cast("string") != "", moved[p]).alias(p) if p in moved else F.col(_name(p))
                    for p in target.partitions
                ]
            )
        )
    texts = [F.col(_name(p)).cast("string") for p in target.partitions]
    return now.distinct().select("*", F.array(*texts).alias("__texts")).collect()


def _in_partitions(target: _Target, touched: list) -> Column:
    """A filter on partition columns only, so that nothing else is listed or read."""
    if len(target.partitions) == 1:
        column = target.partitions[0]
        values = [part[column] for part in touched if part[column] is not None]
        inside = F.col(_name(column)).isin(values) if values else F.lit(False)
        return inside | F.col(_name(column)).isNull() if len(values) < len(touched) else inside

    def same(part) -> Column:
        return reduce(
            lambda a, b: a & b,
            [
                F.col(_name(p)).isNull() if part[p] is None else F.col(_name(p)) == F.lit(part[p])
                for p in target.partitions
            ],
        )

    return _any([same(part) for part in touched])


def _any(conditions: list[Column]) -> Column:
    """OR over many conditions as a balanced tree, so that thousands of partitions do not nest thousands deep."""
    while len(conditions) > 1:
        conditions = [reduce(lambda a, b: a | b, conditions[i : i + 2]) for i in range(0, len(conditions), 2)]
    return conditions[0]


def _point_at(spark: SparkSession, target: _Target, folder: str, touched: list) -> None:
    """Write down what the swap is, then do it."""
    files = _Files(spark, target.root)
    full = set(files.leaves(folder)) if target.partitions else set()
    parts = []
    for part in touched:
        path = "/".join(_partition_folder(p, text) for p, text in zip(target.partitions, part["__texts"]))
        spec = ", ".join(
            f"{_name(p)} = {'NULL' if text in (None, '') else _text(text)}"
            for p, text in zip(target.partitions, part["__texts"])
        )
        parts.append({"path": path, "spec": spec, "full": f"{files.plain(folder)}/{path}" in full})
    files.write(target.root + _INTENT, json.dumps({"folder": folder, "parts": parts}))
    _finish(spark, target)


def _finish(spark: SparkSession, target: _Target) -> bool:
    """Do what is left of a swap that was written down; every step can be repeated. Returns whether there was one."""
    files = _Files(spark, target.root)
    text = files.read(target.root + _INTENT)
    if text is None:
        return False
    intent = json.loads(text)
    folder = intent["folder"]
    # New partitions must not land in a folder that older snapshots used, so the table's own location moves as well.
    spark.sql(f"ALTER TABLE {target.name} SET LOCATION {_text(folder)}")
    if target.partitions:
        known = {row[0] for row in spark.sql(f"SHOW PARTITIONS {target.name}").collect()}
        emptied, added = [], []
        for part in intent["parts"]:
            spec, at = f"PARTITION ({part['spec']})", _text(f"{folder}/{part['path']}")
            if not part["full"]:
                emptied += [spec] if part["path"] in known else []
            elif part["path"] in known:
                spark.sql(f"ALTER TABLE {target.name} {spec} SET LOCATION {at}")
            else:
                added.append(f"{spec} LOCATION {at}")
        if added:
            spark.sql(f"ALTER TABLE {target.name} ADD {' '.join(added)}")
        if emptied:
            spark.sql(f"ALTER TABLE {target.name} DROP {', '.join(emptied)}")
    spark.catalog.refreshTable(target.name)
    files.delete(target.root + _INTENT)
    return True


def _partition_folder(column: str, text: str | None) -> str:
    value = _NULL_PARTITION if text in (None, "") else _escape(text)
    return f"{_escape(column)}={value}"


def _escape(text: str) -> str:
    return "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in text)


def _resolve(df: DataFrame, name: str) -> str:
    found = next((c for c in df.columns if c.lower() == name.lower()), None)
    if found is None:
        raise ValueError(f"no column {name!r} in {df.columns}")
    return found


def _name(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
