"""Sinks (SK-1..8): partition labels and table writes.

Tables are Parquet directories under one warehouse root (a shared, durable
folder on a cluster -- by default a sub-folder of ``spark.checkpoint.dir``).
Writes go through Spark's file commit protocol, so a lost executor only
re-runs its tasks.  A table counts as present only once its folder holds the
marker that this protocol writes last; the remains of a killed first write are
overwritten by the next one.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# ODS range partitions of the reference.  ``before_2013`` holds
# [2000-01-01, 2013-01-01), one partition per year 2013..2030, ``badyear``
# everything else including NULL.  Bounds are start-inclusive, end-exclusive.
EARLY_LABEL = "before_2013"
DEFAULT_LABEL = "badyear"
EARLY_START_YEAR = 2000
FIRST_YEAR = 2013
LAST_YEAR = 2030
PARTITION_COLUMN = "part"
#: Written last by the commit protocol (fixed name).
COMMITTED = "_SUCCESS"
#: Half of a row are hash keys and hash diffs in hex, four bits a byte: only a codec with entropy coding shrinks them.
#: Its first level takes a hex digit to four bits as well as the default one, in less time.
#: Pages of the second version keep the lengths of texts apart from their bytes and store a repeated text as its length.
CODEC = {"compression": "zstd", "parquet.compression.codec.zstd.level": "1", "parquet.writer.version": "v2"}


def partition_label(c: Column | str, first_year: int = FIRST_YEAR, last_year: int = LAST_YEAR,
                    early_start_year: int = EARLY_START_YEAR) -> Column:
    """SK-1: range-partition label of a DATE/TIMESTAMP value."""
    c = F.col(c) if isinstance(c, str) else c
    y = F.year(c)
    return (
        F.when((y >= early_start_year) & (y < first_year), F.lit(EARLY_LABEL))
        .when((y >= first_year) & (y <= last_year), y.cast("string"))
        .otherwise(F.lit(DEFAULT_LABEL))
    )


def shared_root(spark: SparkSession, name: str = "vaultspark") -> str:
    """A fresh folder under the cluster's shared ``spark.checkpoint.dir``.

    The setting is read from the session; only when it is unset and the master is
    local (tests) a temporary local folder is configured, on a cluster it raises.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        import tempfile

        base = tempfile.mkdtemp(prefix="vaultspark-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{qualified(spark, base).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def qualified(spark: SparkSession, base: str) -> str:
    """A folder as every reader takes it for the same: a local one without scheme, one of another
    default file system in full."""
    if base.startswith("file:"):
        return base[len("file:"):]
    if "://" not in base:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(base)
        fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        if fs.getUri().getScheme() != "file":
            return fs.makeQualified(path).toString()
    return base


@dataclass
class Warehouse:
    """Path-based tables under ``root``; ``<root>/<table>``.

    ``buckets`` maps a table to ``(key, n)``: such a table is also registered
    in the session catalog as an external table bucketed by ``key`` into ``n``
    buckets at the same path.  A join or aggregate on ``key`` then reads it
    without a shuffle -- the growing hubs and links are the target side of every
    yearly anti join, so bucketing them keeps that history out of the shuffle;
    only the (small) new keys move.  ``n`` holds for a new table only: it is
    written beside the table before its first row, and every later session
    re-attaches and appends with the stored number, whatever its own settings.

    ``atomic`` keeps every table that is not bucketed as a list of parts.  A write puts its files
    into a folder of their own and then publishes a new list: a small numbered file, renamed into
    place.  Readers take the newest list, so they see all of a write or nothing of it, also when a
    partition is replaced or the writer is killed.  There is one writer at a time.  Appends
    to bucketed tables use Spark's commit; they are anti-joined, so a repeated load completes a
    partly committed one.  A warehouse is atomic or not for life.
    """

    spark: SparkSession
    root: str
    buckets: dict[str, tuple[str, int]] = field(default_factory=dict)
    atomic: bool = False

    @classmethod
    def for_vault(cls, spark: SparkSession, root: str, n: int | None = None,
                  tables: dict[str, str] | None = None, atomic: bool = False) -> "Warehouse":
        """Warehouse whose hubs and links are bucketed by their hash key;
        ``n`` defaults to ``spark.sql.shuffle.partitions`` so the new rows'
        shuffle lines up with the buckets."""
        n = n or int(spark.conf.get("spark.sql.shuffle.partitions"))
        tables = tables or {
            "hub_user": "USER_PK", "hub_account": "ACCOUNT_PK",
            "hub_billing_period": "BILLING_PERIOD_PK", "hub_pay_doc_type": "PAY_DOC_TYPE_PK",
            "hub_paydoc": "PAYDOC_PK", "link_payment": "PAYMENT_PK", "link_paydoc_payment": "PAY_PK",
        }
        return cls(spark, root, {t: (k, n) for t, k in tables.items()}, atomic)

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table_name(self, name: str) -> str:
        tag = hashlib.sha1(self.root.encode()).hexdigest()[:10]
        return f"vs_{tag}_{name}"

    def _hadoop(self, path: str):
        """(file system, path) of any store Spark reaches; errors are not hidden."""
        jvm = self.spark.sparkContext._jvm
        hp = jvm.org.apache.hadoop.fs.Path(path)
        return hp.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), hp

    def _bucket_file(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/_buckets/{name}"

    def bucket_count(self, name: str) -> int:
        """The number of buckets stored with the table; that of a new table is
        stored first.  A table without a stored number, or a catalog entry
        with another one, raises."""
        fs, hp = self._hadoop(self._bucket_file(name))
        if fs.exists(hp):
            stream = fs.open(hp)
            try:
                n = int(stream.readUTF())
            finally:
                stream.close()
        elif self.exists(name):
            raise ValueError(f"the number of buckets of {self.path(name)} is not stored")
        else:
            n = self.buckets[name][1]
            stream = fs.create(hp, True)
            try:
                stream.writeUTF(str(n))
            finally:
                stream.close()
        if self.spark.catalog.tableExists(self.table_name(name)):
            info = self.spark.sql(f"DESCRIBE EXTENDED {self.table_name(name)}").where("col_name = 'Num Buckets'").collect()
            if [r["data_type"] for r in info] != [str(n)]:
                raise ValueError(f"the catalog has another number of buckets than {n} for {self.path(name)}")
        return n

    def _register(self, name: str, schema: T.StructType) -> None:
        key, n = self.buckets[name][0], self.bucket_count(name)
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        self.spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table_name(name)} ({cols}) USING parquet "
                       f"CLUSTERED BY (`{key}`) INTO {n} BUCKETS LOCATION '{self.path(name)}'")

    def _bucketed_write(self, name: str, df: DataFrame, mode: str) -> None:
        key, n = self.buckets[name][0], self.bucket_count(name)
        if mode == "append" and self.exists(name) and not self.spark.catalog.tableExists(self.table_name(name)):
            # saveAsTable would take it for a new table and write over it
            self._register(name, self.spark.read.parquet(self.path(name)).schema)
        # one file per bucket and write task: rows are hash-partitioned by the
        # bucket key the way bucketing assigns them
        (df.repartition(n, key).write.options(**CODEC).bucketBy(n, key).format("parquet")
         .option("path", self.path(name)).mode(mode).saveAsTable(self.table_name(name)))

    # lists of parts

    def _listed(self, name: str) -> bool:
        return self.atomic and name not in self.buckets

    def _lists(self, name: str) -> list[int]:
        fs, hp = self._hadoop(f"{self.path(name)}.lists")
        if not fs.exists(hp):
            return []
        return sorted(int(n) for n in (f.getPath().getName() for f in fs.listStatus(hp)) if n.isdigit())

    def parts(self, name: str) -> dict[str, str]:
        """Part -> folder of the newest published list, in the order of their first writing."""
        numbers = self._lists(name)
        if not numbers:
            return {}
        fs, hp = self._hadoop(f"{self.path(name)}.lists/{numbers[-1]:010d}")
        stream = fs.open(hp)
        try:
            return {stream.readUTF(): stream.readUTF() for _ in range(stream.readInt())}
        finally:
            stream.close()

    def _publish(self, name: str, parts: dict[str, str]) -> None:
        number = (self._lists(name) or [0])[-1] + 1
        folder = f"{self.path(name)}.lists"
        fs, aside = self._hadoop(f"{folder}/_{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        try:
            stream.writeInt(len(parts))
            for part, where in parts.items():
                stream.writeUTF(part)
                stream.writeUTF(where)
        finally:
            stream.close()
        target = self._hadoop(f"{folder}/{number:010d}")[1]
        if fs.exists(target) or not fs.rename(aside, target):
            raise RuntimeError(f"another writer has published list {number} of {self.path(name)}")

    def _write_part(self, name: str, df: DataFrame, partition_by: str | None = None) -> str:
        folder = f"{self.path(name)}.parts/{uuid.uuid4().hex}"
        w = df.write.options(**CODEC)
        (w.partitionBy(partition_by) if partition_by else w).parquet(folder)
        return folder

    def _read_parts(self, name: str, schema: T.StructType | None, without: str | None) -> DataFrame:
        parts = {k: v for k, v in self.parts(name).items() if k != without}
        if schema is None:
            if not parts:
                raise ValueError(f"no rows and no schema for {self.path(name)}")
            schema = self.spark.read.parquet(next(iter(parts.values()))).schema
        plain = [where for part, where in parts.items() if "=" not in part]
        found = [self.spark.read.schema(schema).parquet(*plain)] if plain else []
        for part, where in parts.items():
            column, eq, label = part.partition("=")
            if not eq:
                continue
            kind = schema[column].dataType if column in schema.names else T.StringType()
            fields = T.StructType([f for f in schema.fields if f.name != column])
            found.append(self.spark.read.schema(fields).parquet(where).withColumn(column, F.lit(label).cast(kind)).select(
                *schema.names, *([] if column in schema.names else [column])))
        return reduce(DataFrame.unionByName, found) if found else self.spark.createDataFrame([], schema)

    def vacuum(self) -> None:
        """Remove folders and lists that the newest lists do not name, when no reader is at an older one."""
        fs, hp = self._hadoop(self.root)
        for table in [f.getPath().getName().removesuffix(".lists") for f in fs.listStatus(hp) if f.getPath().getName().endswith(".lists")]:
            kept = {where.split("/")[len(self.path(table).split("/"))] for where in self.parts(table).values()}
            for folder, keep in ((f"{self.path(table)}.parts", kept), (f"{self.path(table)}.lists", {f"{self._lists(table)[-1]:010d}"})):
                fs, hp = self._hadoop(folder)
                for f in (fs.listStatus(hp) if fs.exists(hp) else []):
                    if f.getPath().getName() not in keep:
                        fs.delete(f.getPath(), True)

    def exists(self, name: str) -> bool:
        """Is the table there and its first write committed?"""
        if self._listed(name):
            return bool(self._lists(name))
        fs, hp = self._hadoop(f"{self.path(name)}/{COMMITTED}")
        return fs.exists(hp)

    def names(self) -> list[str]:
        """Names of the tables whose first write is committed and that are not bucketed."""
        fs, hp = self._hadoop(self.root)
        if not fs.exists(hp):
            return []
        found = [f.getPath().getName() for f in fs.listStatus(hp) if f.isDirectory()]
        if self.atomic:
            return sorted(n.removesuffix(".lists") for n in found if n.endswith(".lists"))
        return sorted(n for n in found if n not in self.buckets and self.exists(n))

    def partitions(self, name: str, column: str) -> list[str]:
        """Labels of the committed partition folders written by ``overwrite_partition``."""
        if self._listed(name):
            return [p.partition("=")[2] for p in self.parts(name) if p.startswith(f"{column}=")]
        fs, hp = self._hadoop(self.path(name))
        if not fs.exists(hp):
            return []
        names = [f.getPath().getName() for f in fs.listStatus(hp) if f.isDirectory()]
        labels = [x.partition("=")[2] for x in names if x.startswith(f"{column}=")]
        return [x for x in labels if fs.exists(self._hadoop(f"{self.path(name)}/{column}={x}/{COMMITTED}")[1])]

    def read(self, name: str, schema: T.StructType | None = None, without: str | None = None) -> DataFrame:
        """``without``: a part of an atomic table to leave out."""
        if self._listed(name):
            return self._read_parts(name, schema, without)
        if name in self.buckets:
            if not self.spark.catalog.tableExists(self.table_name(name)):
                self._register(name, schema or self.spark.read.parquet(self.path(name)).schema)
            return self.spark.table(self.table_name(name))
        reader = self.spark.read
        if schema is not None:
            reader = reader.schema(schema)
        return reader.parquet(self.path(name))

    # SK-5
    def create_if_missing(self, name: str, schema: T.StructType,
                          partition_by: str | None = None) -> bool:
        if name in self.buckets:
            if self.exists(name):
                self._register(name, schema)
                return False
            self._bucketed_write(name, self.spark.createDataFrame([], schema), "overwrite")
            return True
        if self.exists(name):
            return False
        if self.atomic:
            self._publish(name, {})
            return True
        empty = self.spark.createDataFrame([], schema)
        w = empty.write.mode("overwrite")  # only remains of a killed write can be there
        if partition_by:
            w = w.partitionBy(partition_by)
        w.parquet(self.path(name))
        return True

    # SK-2 / SK-3: static overwrite of one partition, also when the batch is empty
    def overwrite_partition(self, name: str, label: str, df: DataFrame,
                            column: str = PARTITION_COLUMN) -> None:
        if self._listed(name):
            folder = self._write_part(name, df.drop(column))
            self._publish(name, {**self.parts(name), f"{column}={label}": folder})
            return
        target = f"{self.path(name)}/{column}={label}"
        df.drop(column).write.options(**CODEC).mode("overwrite").parquet(target)

    def drop_partitions(self, name: str, labels: list[str], column: str = PARTITION_COLUMN) -> None:
        """Remove partition directories (a file-system operation, no job)."""
        if self._listed(name):
            gone = {f"{column}={label}" for label in labels}
            held = self.parts(name)
            if gone & held.keys():
                self._publish(name, {p: w for p, w in held.items() if p not in gone})
            return
        for label in labels:
            fs, hp = self._hadoop(f"{self.path(name)}/{column}={label}")
            fs.delete(hp, True)

    def _partition_files(self, name: str, column: str) -> dict[str, set[str]]:
        """Partition folder -> names of its data files."""
        fs, hp = self._hadoop(self.path(name))
        folders = [f.getPath() for f in fs.listStatus(hp) if f.isDirectory()] if fs.exists(hp) else []
        return {p.getName(): {f.getPath().getName() for f in fs.listStatus(p)} for p in folders if p.getName().startswith(f"{column}=")}

    def overwrite_partitions(self, name: str, df: DataFrame, column: str = PARTITION_COLUMN) -> set[str]:
        """Dynamic overwrite: replace exactly the partitions present in ``df``; their labels are returned.  The names
        of written files are new in each write, so the folders tell them without a second pass over ``df``."""
        if self._listed(name):
            folder = self._write_part(name, df, column)
            fs, hp = self._hadoop(folder)
            new = [f.getPath().getName() for f in fs.listStatus(hp) if f.isDirectory() and f.getPath().getName().startswith(f"{column}=")]
            self._publish(name, {**self.parts(name), **{p: f"{folder}/{p}" for p in new}})
        else:
            before = self._partition_files(name, column)
            (df.write.options(**CODEC).mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy(column).parquet(self.path(name)))
            new = [p for p, files in self._partition_files(name, column).items() if files - before.get(p, set())]
        return {p.partition("=")[2] for p in new}

    # SK-4: append rows with an explicit column list
    def append(self, name: str, df: DataFrame, columns: list[str] | None = None,
               cluster_by: list[str] | None = None, part: str | None = None) -> None:
        """``cluster_by``: files hold ranges of these columns in order, so the statistics of
        their row groups tell them apart.  Ranges of several columns split a key that fills many files."""
        if columns:
            df = df.select(*columns)
        if name in self.buckets:
            self._bucketed_write(name, df, "append")
            return
        if cluster_by:
            df = df.repartitionByRange(*cluster_by).sortWithinPartitions(*cluster_by)
        if self.atomic:  # a part written again under its name is replaced: the append happens once
            folder = self._write_part(name, df)
            self._publish(name, {**self.parts(name), part or uuid.uuid4().hex: folder})
            return
        df.write.options(**CODEC).mode("append").parquet(self.path(name))

    # SK-6 / SK-7 / SK-8: replace a whole table
    def replace(self, name: str, df: DataFrame) -> None:
        if name in self.buckets:
            self._bucketed_write(name, df, "overwrite")
            return
        if self.atomic:
            self._publish(name, {"all": self._write_part(name, df)})
            return
        df.write.options(**CODEC).mode("overwrite").parquet(self.path(name))

    def drop(self, name: str) -> None:
        """Remove a table that is not bucketed."""
        for folder in ([f"{self.path(name)}.lists", f"{self.path(name)}.parts"] if self.atomic else [self.path(name)]):
            fs, hp = self._hadoop(folder)
            fs.delete(hp, True)

    # SR-3 style: write once, skipped if the target exists
    def write_once(self, name: str, df: DataFrame) -> bool:
        if self.exists(name):
            return False
        if self.atomic:
            self.replace(name, df)
            return True
        df.write.options(**CODEC).mode("overwrite").parquet(self.path(name))  # only remains of a killed write can be there
        return True



class Journal:
    """Finished steps of a named run, one small file each beside the tables, and notes that a step needs again
    if it is repeated.  Files are renamed into place."""

    def __init__(self, wh: Warehouse, run: str) -> None:
        self.wh, self.folder = wh, f"{wh.root.rstrip('/')}/_journal/{run}"

    def read(self, step: str) -> str | None:
        fs, hp = self.wh._hadoop(f"{self.folder}/{step}")
        if not fs.exists(hp):
            return None
        stream = fs.open(hp)
        try:
            return stream.readUTF()
        finally:
            stream.close()

    def write(self, step: str, text: str = "") -> None:
        fs, aside = self.wh._hadoop(f"{self.folder}/_{uuid.uuid4().hex}")
        stream = fs.create(aside, False)
        try:
            stream.writeUTF(text)
        finally:
            stream.close()
        target = self.wh._hadoop(f"{self.folder}/{step}")[1]
        if fs.exists(target) or not fs.rename(aside, target):
            raise RuntimeError(f"step {step} of {self.folder} has been finished by another run")

    def step(self, name: str, action) -> None:
        """Run ``action`` unless it is finished; note it when it is."""
        if self.read(name) is None:
            action()
            self.write(name)

    def note(self, name: str, value) -> str:
        """The noted value; that of ``value()`` is noted first where there is none."""
        held = self.read(name)
        if held is None:
            held = value()
            self.write(name, held)
        return held

    def close(self) -> None:
        fs, hp = self.wh._hadoop(self.folder)
        fs.delete(hp, True)
