"""SQLite files as a Spark data source.

Reading: ``path`` is one database file, a folder of them or a pattern, on a file system that the driver and every
executor mount under the same path. The columns are those of all files together, by name; one that a file lacks is NULL
for its rows, and one that two files declare with different types is refused. A large file is split into ranges of row ids, one task per range; small files are
read several per task and not even opened for planning. The columns and the condition that SQLite should apply are
given to the read. Filters are not pushed by Spark on its own: in Spark 4.1 a Python source with pushed filters keeps
those of one query for the next query over the same DataFrame.

Writing: a folder of database files, one per task, each holding the table. One SQLite file takes one writer at a
time, so a single file could only be written through a single task. A task builds its file under a temporary name and
the commit on the driver gives the files of successful attempts their final names, one after the other, and removes
those that lost and repeated attempts left. Readers only see final names.
"""

from __future__ import annotations

import glob
import heapq
import json
import os
import sqlite3
import sys
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, urlparse

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)

# Executors need not have this package installed: ship its classes by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FILE_PATTERNS = ("*.db", "*.sqlite", "*.sqlite3")
BYTES_PER_PARTITION = 64 << 20
#: From this many files on, their columns are looked up by a Spark job instead of one after the other.
FILES_FOR_A_JOB = 64
FETCH_ROWS = 20_000
#: Rows between two keys at which a table without row ids may be cut.
KEYS_PER_STEP = 20_000
#: Ranges of row ids that are looked up for each task, to even out gaps.
RANGES_PER_TASK = 8

#: A stored value by its class; one of the four is set, none for NULL.
STORED = T.StructType(
    [
        T.StructField("integer", T.LongType()),
        T.StructField("real", T.DoubleType()),
        T.StructField("text", T.StringType()),
        T.StructField("blob", T.BinaryType()),
    ]
)
#: What a column is read as, unless as what it declares.
TYPINGS = {"declared": None, "text": T.StringType(), "stored": STORED}


def use_sqlite(spark: SparkSession) -> None:
    """Make ``spark.read.format("sqlite")`` available."""
    spark.dataSource.register(SqliteDataSource)


def read_sqlite(
    spark: SparkSession,
    path: str,
    table: str,
    columns: list[str] | None = None,
    where: str | None = None,
    params: list | None = None,
    typing: str = "declared",
    num_partitions: int | None = None,
    limit: int | None = None,
    split_by: list[str] | None = None,
    ranges: list[list] | None = None,
) -> DataFrame:
    """Lazy scan of ``table``; only ``columns``, and rows for which ``where`` is true, leave the file.

    ``where`` is a condition in SQLite's own SQL, with ``?`` for each of ``params`` (numbers and text). With ``limit``
    any so many of these rows are read: every piece of the files stops there, and so does the result.

    Large files are cut into tasks by row id, tables without row ids by their primary key. ``split_by`` names columns to
    cut by instead, which a view needs, as it has neither. ``ranges`` reads some of the ranges of :func:`ranges_of` only.

    ``typing="declared"`` takes the declared column types and fails on a value that does not fit its column.
    ``typing="stored"`` gives VARIANT columns that hold each value in the class in which SQLite stores it, whatever the
    column says: whole number, real, text or bytes; the ladder ``stored`` of :func:`rowmill.functions.infer_types` then
    finds a type for all of them. ``typing="text"`` reads every value as text and so forgets the classes.
    """
    if typing not in TYPINGS:
        raise ValueError(f"unknown typing {typing!r}, expected one of {sorted(TYPINGS)}")
    use_sqlite(spark)
    reader = spark.read.format("sqlite").option("path", path).option("table", table).option("typing", typing)
    if where is not None:
        reader = reader.option("where", where).option("params", json.dumps(list(params or [])))
    if num_partitions:
        reader = reader.option("numPartitions", str(num_partitions))
    if limit is not None:
        reader = reader.option("limit", str(limit))
    if split_by:
        reader = reader.option("splitBy", json.dumps(list(split_by)))
    if ranges is not None:
        reader = reader.option("pieces", json.dumps(ranges))
    schema = merged_schema(_declared_in(spark, database_files(path), table), typing)
    if columns:
        known = {field.name: field for field in schema}
        schema = T.StructType([known[name] for name in columns])
    rows = reader.schema(schema).load()
    if typing == "stored":
        rows = rows.select(*(_as_variant(field.name) for field in schema))
    return rows if limit is None else rows.limit(limit)


def _named(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _by_kind(name: str) -> Column:
    """A VARIANT as a struct of :data:`STORED`."""
    value = _named(name)
    kind = F.schema_of_variant(value)
    of = lambda wanted: F.try_variant_get(value, "$", wanted)
    number = kind.isin("DOUBLE", "FLOAT") | kind.startswith("DECIMAL")
    cell = F.struct(
        F.when(kind == "BIGINT", of("bigint")).when(kind == "BOOLEAN", of("boolean").cast("bigint")).alias("integer"),
        F.when(number, of("double")).alias("real"),
        F.when(~number & ~kind.isin("BIGINT", "BOOLEAN", "BINARY", "VOID"), of("string")).alias("text"),
        F.when(kind == "BINARY", of("binary")).alias("blob"),
    )
    return cell.alias(name)


def _as_variant(name: str) -> Column:
    """One value out of the four that a stored one may be."""
    cell = _named(name)
    return F.coalesce(*(cell[kind].cast("variant") for kind in STORED.names)).alias(name)


def write_sqlite(df: DataFrame, path: str, table: str, load: str | None = None, key: list[str] | None = None) -> int:
    """Append ``df`` to the folder ``path``, one new database file per task; returns the number of rows written.

    With ``load``, a word, the files are named by it, and those of an earlier call with the same one give way: a load
    that may have broken off can be repeated. With ``key`` each file keeps its rows in the order of these columns, as a
    table without row ids that looks them up at once; a key that is NULL or repeated in a task's rows fails the job.

    A VARIANT column is declared without a type, and each of its values stored in its own class: numbers as whole ones
    or reals, truth values as 0 and 1, bytes as bytes, objects, arrays and the rest as text. Refused if the folder's
    files declare a column of the same name with another type.
    """
    spark = df.sparkSession
    use_sqlite(spark)
    df = df.select(*(_by_kind(field.name) if isinstance(field.dataType, T.VariantType) else _named(field.name) for field in df.schema))
    if os.path.isdir(local_path(path)) and (files := _existing_files(local_path(path))):
        own = ("the new rows", [(field.name, sqlite_type(field.dataType)) for field in df.schema])
        merged_schema([*_declared_in(spark, files, table), own], "declared")
    counted = Observation()
    rows = df.observe(counted, F.count(F.lit(1)).alias("rows"))
    if load is not None and not load.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"a load's name is letters, digits, - and _, not {load!r}")
    writer = rows.write.format("sqlite").mode("append").option("path", path).option("table", table)
    writer = writer.option("load", load) if load else writer
    (writer.option("key", json.dumps(list(key))) if key else writer).save()
    return counted.get["rows"]


class SqliteDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "sqlite"

    def schema(self) -> T.StructType:
        files, table = database_files(self.options["path"]), self.options["table"]
        return merged_schema([declared_in(path, table) for path in files], self.options.get("typing", "declared"))

    def reader(self, schema: T.StructType) -> DataSourceReader:
        return SqliteReader(schema, self.options)

    def writer(self, schema: T.StructType, overwrite: bool) -> DataSourceArrowWriter:
        if overwrite:
            raise ValueError("the sqlite sink appends; write to a new folder instead of overwriting")
        return SqliteWriter(schema, self.options)


@dataclass
class Piece:
    """Rows of one file: low <= row id <= high, or low < key <= high; the whole table without row id and key."""

    path: str
    rowid: str | None = None
    low: int | tuple | None = None
    high: int | tuple | None = None
    key: tuple[str, ...] = ()

    def condition(self) -> tuple[str, list]:
        if self.rowid:
            return f"{self.rowid} BETWEEN ? AND ?", [self.low, self.high]
        if not self.key or (self.low is None and self.high is None):
            return "", []
        names = [identifier(name) for name in self.key]
        own = f"({', '.join(names)})"
        marks = f"({', '.join('?' * len(names))})"
        parts, values = [f"{name} IS NOT NULL" for name in names], []
        for sign, end in ((">", self.low), ("<=", self.high)):
            if end is not None:
                parts.append(f"{own} {sign} {marks}")
                values += end
        whole = " AND ".join(parts)
        if self.low is None:  # keys with NULL come with the first piece
            whole = f"(({whole}) OR " + " OR ".join(f"{name} IS NULL" for name in names) + ")"
        return whole, values


def _told(piece: Piece) -> list:
    """A piece as JSON can say it: its fields, bytes as hexadecimal text."""
    plain = lambda end: [["hex", v.hex()] if isinstance(v, bytes) else v for v in end] if isinstance(end, tuple) else end
    return [piece.path, piece.rowid, plain(piece.low), plain(piece.high), list(piece.key)]


def _piece(told: list) -> Piece:
    path, rowid, low, high, key = told
    back = lambda end: tuple(bytes.fromhex(v[1]) if isinstance(v, list) else v for v in end) if isinstance(end, list) else end
    return Piece(path, rowid, back(low), back(high), tuple(key))


def ranges_of(path: str, table: str, num_ranges: int) -> list[list]:
    """About so many ranges of rows that together are the table, for the ``ranges`` of :func:`read_sqlite`."""
    reader = SqliteReader(T.StructType(), {"path": path, "table": table, "numPartitions": str(num_ranges)})
    return [_told(piece) for part in reader.partitions() for piece in part.pieces]


@dataclass
class Pieces(InputPartition):
    """What one task reads."""

    pieces: list[Piece]


class SqliteReader(DataSourceReader):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns = [(field.name, field.dataType) for field in schema]
        self.path = options["path"]
        self.table = options["table"]
        self.typing = options.get("typing", "declared")
        self.limit = int(options["limit"]) if "limit" in options else None
        self.bytes_per_partition = int(options.get("bytesPerPartition", BYTES_PER_PARTITION))
        self.num_partitions = int(options.get("numPartitions", 0))
        self.split_by = tuple(json.loads(options.get("splitBy", "[]")))
        self.pieces = json.loads(options["pieces"]) if "pieces" in options else None
        self.where = options.get("where")
        self.params = json.loads(options.get("params", "[]"))

    def partitions(self) -> list[Pieces]:
        if self.pieces is not None:
            return [Pieces([_piece(told)]) for told in self.pieces]
        files = database_files(self.path)
        if self.num_partitions:
            per_file = -(-self.num_partitions // len(files))
            return [Pieces([piece]) for path in files for piece in self._split(path, per_file)]
        parts, packed, packed_bytes = [], [], 0
        for path in files:
            size = os.path.getsize(path)
            if size > self.bytes_per_partition:
                parts += [Pieces([piece]) for piece in self._split(path, -(-size // self.bytes_per_partition))]
                continue
            if packed and packed_bytes + size > self.bytes_per_partition:
                parts.append(Pieces(packed))
                packed, packed_bytes = [], 0
            packed.append(Piece(path))
            packed_bytes += size
        return parts + [Pieces(packed)] if packed else parts

    def _split(self, path: str, wanted: int) -> list[Piece]:
        with connect(path) as connection:
            if self.split_by:
                return self._split_by_key(connection, path, self.split_by, wanted)
            taken = {name.lower() for name, _ in declared_columns(connection, self.table)}
            rowid = next((n for n in ("rowid", "_rowid_", "oid") if n not in taken), None)
            try:
                # two lookups at the ends of the b-tree; one SELECT with both would read it all
                ends = f"SELECT (SELECT min({rowid}) FROM {identifier(self.table)}), " + (
                    f"(SELECT max({rowid}) FROM {identifier(self.table)})"
                )
                low, high = connection.execute(ends).fetchone() if rowid else (None, None)
            except sqlite3.OperationalError:  # a WITHOUT ROWID table
                return self._split_by_key(connection, path, primary_key(connection, self.table), wanted)
            if low is None or high is None:  # an empty table, or a view
                return [Piece(path)]
            ranges = self._without_gaps(connection, rowid, low, high, wanted)
        share, pieces, taken_ids = -(-sum(end - start + 1 for start, end in ranges) // wanted), [], 0
        for start, end in ranges:
            if not pieces or taken_ids >= share:
                pieces.append(Piece(path, rowid, start, end))
                taken_ids = 0
            pieces[-1].high = end
            taken_ids += end - start + 1
        return pieces

    def _split_by_key(self, connection: sqlite3.Connection, path: str, key: tuple[str, ...], wanted: int) -> list[Piece]:
        """Pieces of equally many rows in the order of a key of any type.

        The key is walked once in steps of ``KEYS_PER_STEP``, inside SQLite, along its index where it has one; only the
        key at the end of each step comes back.
        """
        if not key or wanted <= 1:
            return [Piece(path)]
        names = [f"{identifier(self.table)}.{identifier(name)}" for name in key]
        listed, whole = ", ".join(names), " AND ".join(f"{name} IS NOT NULL" for name in names)
        step = f"SELECT {listed} FROM {identifier(self.table)} WHERE {whole}{{beyond}} ORDER BY {listed} LIMIT 1 OFFSET {KEYS_PER_STEP - 1}"
        beyond = f" AND ({listed}) > ({', '.join('?' * len(key))})"
        ends = []
        while end := connection.execute(step.format(beyond=beyond if ends else ""), ends[-1] if ends else ()).fetchone():
            ends.append(end)
        steps = len(ends) + 1
        cuts = list(dict.fromkeys(ends[k * steps // wanted - 1] for k in range(1, wanted) if k * steps // wanted >= 1))
        return [Piece(path, None, low, high, tuple(key)) for low, high in zip([None, *cuts], [*cuts, None])]

    def _without_gaps(self, connection: sqlite3.Connection, rowid: str, low: int, high: int, wanted: int) -> list[tuple]:
        """Ranges of row ids that begin and end with a row, in order: the widest is cut in the middle, again and again.

        Each cut takes two lookups in the index and leaves out the gap that it falls into, so ids far from the others
        do not widen a range.
        """
        source, ranges = identifier(self.table), [(low - high, low, high)]
        while len(ranges) < RANGES_PER_TASK * wanted and ranges[0][0] < 0:
            _, start, end = heapq.heappop(ranges)
            middle = start + (end - start) // 2
            below = f"SELECT max({rowid}) FROM {source} WHERE {rowid} BETWEEN ? AND ?"
            above = f"SELECT min({rowid}) FROM {source} WHERE {rowid} BETWEEN ? AND ?"
            last = connection.execute(below, (start, middle)).fetchone()[0]
            first = connection.execute(above, (middle + 1, end)).fetchone()[0]
            heapq.heappush(ranges, (start - last, start, last))
            heapq.heappush(ranges, (first - end, first, end))
        return sorted((start, end) for _, start, end in ranges)

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        for piece in partition.pieces:
            yield from self._read(piece)

    def _read(self, piece: Piece) -> Iterator[pa.RecordBatch]:
        conditions, values = [], []
        if self.where:
            conditions.append(f"({self.where})")
            values += self.params
        own, ends = piece.condition()
        if own:
            conditions.append(own)
            values += ends
        where = f" WHERE {' AND '.join(conditions)}" if conditions else ""
        if self.limit is not None:
            where += " LIMIT ?"
            values.append(self.limit)
        with connect(piece.path) as connection:
            present = {name.lower() for name, _ in declared_columns(connection, self.table)}
            # with the table before it, a name that is no column is an error and never a text
            cells = [f"{identifier(self.table)}.{identifier(n)}" if n.lower() in present else "NULL" for n, _ in self.columns]
            names = ", ".join(cells) or "NULL"
            cursor = connection.execute(f"SELECT {names} FROM {identifier(self.table)}{where}", values)
            while rows := cursor.fetchmany(FETCH_ROWS):
                arrays = [self._array(i, cells) for i, cells in enumerate(zip(*rows))]
                yield pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in self.columns])

    def _array(self, position: int, cells: tuple) -> pa.Array:
        name, data_type = self.columns[position]
        if self.typing == "text":
            return pa.array([_as_text(cell) for cell in cells], pa.string())
        if self.typing == "stored":
            return _by_class(cells)
        try:
            if isinstance(data_type, (T.DateType, T.TimestampNTZType)):
                return pa.array(cells, pa.string()).cast(arrow_type(data_type))
            if isinstance(data_type, T.TimestampType):
                return pa.array(cells, pa.string()).cast(pa.timestamp("us")).cast(arrow_type(data_type))
            if isinstance(data_type, T.BooleanType):
                cells = [None if c is None else _as_flag(c) for c in cells]
            return pa.array(cells, arrow_type(data_type))
        except (pa.lib.ArrowException, TypeError, ValueError) as problem:
            raise ValueError(
                f"column {name} of {self.table} holds a value that is not {data_type.simpleString()} ({problem}); "
                'read it with option typing="text" and infer the types'
            ) from problem


@dataclass
class WrittenFile(WriterCommitMessage):
    path: str | None


class SqliteWriter(DataSourceArrowWriter):
    def __init__(self, schema: T.StructType, options: dict):
        self.columns = [(field.name, sqlite_type(field.dataType)) for field in schema]
        self.folder = local_path(options["path"])
        self.table = options["table"]
        self.load = options.get("load")
        self.key = json.loads(options.get("key", "[]"))
        self.job = uuid.uuid4().hex

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WrittenFile:
        os.makedirs(self.folder, exist_ok=True)
        path = self._new_file()
        connection = None
        try:
            for batch in iterator:
                if batch.num_rows == 0:
                    continue
                connection = connection or self._create(path)
                connection.executemany(self._insert(), zip(*[_cells(column) for column in batch.columns]))
            if connection is None:
                return WrittenFile(None)
            connection.commit()
            connection.close()
            return WrittenFile(path)
        except BaseException:
            if connection is not None:
                connection.close()
                os.remove(path)
            raise

    def _new_file(self) -> str:
        return os.path.join(self.folder, f"_attempt-{self.job}-{uuid.uuid4().hex}")

    def _create(self, path: str) -> sqlite3.Connection:
        connection = sqlite3.connect(path)
        connection.execute("PRAGMA journal_mode = OFF")
        connection.execute("PRAGMA synchronous = OFF")
        columns = ", ".join(f"{identifier(name)} {kind}" for name, kind in self.columns)
        if self.key:
            columns += f", PRIMARY KEY ({', '.join(identifier(name) for name in self.key)})) WITHOUT ROWID"
        connection.execute(f"CREATE TABLE {identifier(self.table)} ({columns}" + ("" if self.key else ")"))
        return connection

    def _insert(self) -> str:
        return f"INSERT INTO {identifier(self.table)} VALUES ({', '.join('?' * len(self.columns))})"

    def commit(self, messages: list[WrittenFile | None]) -> None:
        written = [m.path for m in messages if m is not None and m.path]
        if not written and not _existing_files(self.folder):
            # keep the schema of an empty result
            os.makedirs(self.folder, exist_ok=True)
            empty = self._new_file()
            connection = self._create(empty)
            connection.commit()
            connection.close()
            written = [empty]
        if self.load:
            for path in glob.glob(os.path.join(glob.escape(self.folder), f"part-{self.load}.*.db")):
                os.remove(path)
        for path in written:
            os.replace(path, path.replace("_attempt-", f"part-{self.load}." if self.load else "part-") + ".db")
        self._remove_attempts()

    def abort(self, messages: list[WrittenFile | None]) -> None:
        self._remove_attempts()

    def _remove_attempts(self) -> None:
        for path in glob.glob(os.path.join(glob.escape(self.folder), f"_attempt-{self.job}-*")):
            os.remove(path)


def local_path(path: str) -> str:
    parts = urlparse(path)
    if parts.scheme not in ("", "file"):
        raise ValueError(f"SQLite needs files on a mounted file system, not {path!r}")
    return parts.path if parts.scheme else path


def _existing_files(folder: str) -> list[str]:
    return sorted(f for pattern in FILE_PATTERNS for f in glob.glob(os.path.join(glob.escape(folder), pattern)))


def database_files(path: str) -> list[str]:
    """The database files behind a file name, a folder or a pattern."""
    where = local_path(path)
    if os.path.isfile(where):
        return [where]
    files = _existing_files(where) if os.path.isdir(where) else sorted(glob.glob(where))
    if not files:
        raise FileNotFoundError(f"no SQLite database at {path!r}")
    return files


class connect:
    """A read-only connection, closed at the end of the block."""

    def __init__(self, path: str):
        self.connection = sqlite3.connect(f"file:{quote(path)}?mode=ro", uri=True)

    def __enter__(self) -> sqlite3.Connection:
        return self.connection

    def __exit__(self, *_) -> None:
        self.connection.close()


def identifier(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def declared_columns(connection: sqlite3.Connection, table: str) -> list[tuple[str, str]]:
    found = [(row[1], row[2] or "") for row in connection.execute(f"PRAGMA table_info({identifier(table)})")]
    if not found:
        raise ValueError(f"no table {table!r} in the database")
    return found


def primary_key(connection: sqlite3.Connection, table: str) -> tuple[str, ...]:
    """The columns of the table's primary key, in their order in it."""
    found = [(row[5], row[1]) for row in connection.execute(f"PRAGMA table_info({identifier(table)})") if row[5]]
    return tuple(name for _, name in sorted(found))


def declared_in(path: str, table: str) -> tuple[str, list[tuple[str, str]]]:
    with connect(path) as connection:
        return path, declared_columns(connection, table)


def _declared_in(spark: SparkSession, files: list[str], table: str) -> list[tuple[str, list[tuple[str, str]]]]:
    """The columns that each file declares; of many files, one example of each different list."""
    if len(files) < FILES_FOR_A_JOB:
        return [declared_in(path, table) for path in files]

    def look(batches):
        for batch in batches:
            found = [declared_in(path, table) for path in batch.column(0).to_pylist()]
            lists = pa.array([json.dumps(columns) for _, columns in found], pa.string())
            yield pa.record_batch([pa.array([path for path, _ in found], pa.string()), lists], names=["path", "columns"])

    paths = spark.createDataFrame([(path,) for path in files], "path string").repartition(max(1, len(files) // 16))
    seen = paths.mapInArrow(look, "path string, columns string").groupBy("columns").agg(F.min("path").alias("path"))
    return sorted((r.path, [tuple(c) for c in json.loads(r.columns)]) for r in seen.collect())


def merged_schema(declared: list[tuple[str, list[tuple[str, str]]]], typing: str) -> T.StructType:
    """All columns by name (case does not matter, as in SQLite), in the order in which they first appear."""
    fields: dict[str, tuple[T.StructField, str]] = {}
    for path, columns in declared:
        for name, kind in columns:
            field = T.StructField(name, TYPINGS[typing] or spark_type(kind))
            known, first = fields.setdefault(name.lower(), (field, path))
            if known.dataType != field.dataType:
                raise ValueError(
                    f"column {name} is {known.dataType.simpleString()} in {first} and "
                    f"{field.dataType.simpleString()} in {path}; read them with typing=\"text\" or one by one"
                )
    return T.StructType([field for field, _ in fields.values()])


def spark_type(declared: str) -> T.DataType:
    """Column type for a declared SQLite type: dates and booleans by name, the rest by SQLite's affinity rules."""
    kind = declared.upper()
    if "INT" in kind:
        return T.LongType()
    if any(part in kind for part in ("CHAR", "CLOB", "TEXT")):
        return T.StringType()
    if "BLOB" in kind:
        return T.BinaryType()
    if any(part in kind for part in ("REAL", "FLOA", "DOUB", "DEC", "NUM")):
        return T.DoubleType()
    if kind.startswith("BOOL"):
        return T.BooleanType()
    if kind == "DATE":
        return T.DateType()
    if kind in ("TIMESTAMP", "DATETIME"):
        return T.TimestampNTZType()
    return T.StringType()


def arrow_type(data_type: T.DataType) -> pa.DataType:
    return {
        T.ByteType: pa.int8(),
        T.ShortType: pa.int16(),
        T.IntegerType: pa.int32(),
        T.LongType: pa.int64(),
        T.FloatType: pa.float32(),
        T.DoubleType: pa.float64(),
        T.StringType: pa.string(),
        T.BooleanType: pa.bool_(),
        T.BinaryType: pa.binary(),
        T.DateType: pa.date32(),
        T.TimestampType: pa.timestamp("us", tz="UTC"),
        T.TimestampNTZType: pa.timestamp("us"),
    }[type(data_type)]


def sqlite_type(data_type: T.DataType) -> str:
    if isinstance(data_type, T.IntegralType):
        return "INTEGER"
    if isinstance(data_type, (T.FloatType, T.DoubleType)):
        return "REAL"
    if isinstance(data_type, T.BooleanType):
        return "BOOLEAN"
    if isinstance(data_type, T.BinaryType):
        return "BLOB"
    if isinstance(data_type, T.DateType):
        return "DATE"
    if isinstance(data_type, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP"
    if isinstance(data_type, T.StringType):
        return "TEXT"
    if data_type == STORED:
        return ""
    raise ValueError(f"SQLite has no column type for {data_type.simpleString()}; cast the column first")


def _cells(column: pa.Array) -> list:
    """Values as SQLite takes them; dates and times become ISO text, times in UTC."""
    if pa.types.is_timestamp(column.type):
        column = column.cast(pa.timestamp("us")).cast(pa.string())
    elif pa.types.is_date(column.type):
        column = column.cast(pa.string())
    elif pa.types.is_struct(column.type):
        return [next((v for v in values if v is not None), None) for values in zip(*(part.to_pylist() for part in column.flatten()))]
    return column.to_pylist()


def _as_flag(cell: object) -> bool:
    if cell in (0, 1):
        return bool(cell)
    raise ValueError(f"{cell!r} is not 0 or 1")


def _by_class(cells: tuple) -> pa.Array:
    """Values as structs of :data:`STORED`."""
    kinds = ((int, pa.int64()), (float, pa.float64()), (str, pa.string()), (bytes, pa.binary()))
    parts = [pa.array([cell if type(cell) is kind else None for cell in cells], arrow) for kind, arrow in kinds]
    return pa.StructArray.from_arrays(parts, STORED.names)


def _as_text(cell: object) -> str | None:
    if cell is None or isinstance(cell, str):
        return cell
    return cell.hex() if isinstance(cell, bytes) else repr(cell)
