"""Publishing merge results: immutable partition files, one small commit file, an append-only change feed.

A published folder holds one table, or several named ones that are committed together::

    [<name>/]data/_version=<n>/_try=<t>/_tenant=.../[_bucket=...]/   rows that commit n wrote
    [<name>/]parts/<n>-<t>/                                          which version holds each partition
    commits/<n>.json                                                 the state of every table after commit n
    batches/<run>/<batch>.json                                       the commit that a batch went into

and, elsewhere, change feeds and archives as ``_commit=<n>/_try=<t>/`` folders.
A batch writes the partitions it touches, whole tenants or (tenant, key bucket)
pairs, then the list of partitions, in which touched partitions point to the
new files or, if no row is left in them, are gone; then its change rows; and
last the commit file, which appears by one rename that never replaces a file.
That switches readers to all of it, in all tables, at once.  Nothing that
anyone reads is ever overwritten: a batch that fails before its commit left no
trace that is read and runs again, and of two writers that prepare the same
commit the second starts again from the first one's result.  A committed batch
that comes again is a no-op; the same batch id with other rows is an error.

What a call costs does not grow with the number of commits before it: the
newest commit is found from a hint, a batch by its own file, and only files of
versions that are still in use are listed.  :func:`sweep` deletes the others.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.exprs import tenant_key
from tessera.operators.staged import written_once
from tessera.plans.specs import TENANT

VERSION, TRY, BUCKET, COMMIT = "_version", "_try", "_bucket", "_commit"
#: Times that a batch starts again when another writer's commit came first.
ATTEMPTS = 5


class ConcurrentCommit(RuntimeError):
    """Other writers' commits came first, every time."""


# ------------------------------------------------------------------ small files, through Spark's file systems


def _file(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none when it does not exist."""
    fs, p = _file(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _read(spark: SparkSession, path: str) -> str | None:
    fs, p = _file(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _write(spark: SparkSession, path: str, text: str) -> None:
    fs, p = _file(spark, path)
    stream = fs.create(p, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def _write_new(spark: SparkSession, path: str, text: str) -> bool:
    """The whole file appears at once; False when there is one already."""
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}.{uuid.uuid4().hex}"
    _write(spark, draft, text)
    jvm = spark._jvm
    _, p = _file(spark, path)
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    never_replace = spark.sparkContext._gateway.new_array(kind, 1)
    never_replace[0] = kind.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration())
    try:
        context.rename(jvm.org.apache.hadoop.fs.Path(draft), p, never_replace)
    except Py4JJavaError as e:
        fs, d = _file(spark, draft)
        fs.delete(d, False)
        if "FileAlreadyExistsException" in str(e.java_exception):
            return False
        raise
    return True


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _file(spark, path)
    fs.delete(p, True)


# ------------------------------------------------------------------ commits


def latest_commit(spark: SparkSession, path: str) -> int:
    """Number of the newest commit (0: none).  A hint says where to look from; it may be old, never ahead."""
    hint = _read(spark, f"{path}/commits/_latest")
    if not hint:
        return max((int(n[:-5]) for n in _names(spark, f"{path}/commits") if n.endswith(".json") and n[0] != "."), default=0)
    n = int(hint)
    while _file_exists(spark, f"{path}/commits/{n + 1}.json"):
        n += 1
    return n


def _file_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file(spark, path)
    return fs.exists(p)


def _state(spark: SparkSession, path: str, commit: int) -> dict:
    text = _read(spark, f"{path}/commits/{commit}.json") if commit else None
    return json.loads(text) if text else {"commit": 0, "tables": {}}


def _commit(spark: SparkSession, path: str, state: dict) -> bool:
    n = state["commit"]
    if not _write_new(spark, f"{path}/commits/{n}.json", json.dumps(state)):
        return False
    _write(spark, f"{path}/commits/_latest", str(n))
    return True


def _batch_file(path: str, run_id: str, batch_id: int) -> str:
    return f"{path}/batches/{hashlib.sha1(run_id.encode()).hexdigest()}/{batch_id}.json"


def _committed(spark: SparkSession, path: str, batch_id: int, run_id: str, fingerprint: str) -> bool:
    """Whether the batch went into a commit; an error when it did with other rows."""
    note = _read(spark, _batch_file(path, run_id, batch_id))
    if note is None:
        return False
    state = _state(spark, path, json.loads(note)["commit"])
    if (state.get("run_id"), state.get("batch_id")) != (run_id, batch_id):
        return False  # the note was written, its commit was not
    if state["fingerprint"] != fingerprint:
        raise ValueError(f"batch {batch_id} of run {run_id!r} was published at {path} with other rows")
    return True


# ------------------------------------------------------------------ tables


@dataclass(frozen=True)
class Table:
    """A published table as a commit left it."""

    spark: SparkSession
    path: str
    version: int
    attempt: str
    schema: T.StructType
    tenant: str
    bucketed: bool

    @property
    def part_cols(self) -> list[str]:
        return [self.tenant, BUCKET] if self.bucketed else [self.tenant]

    def parts(self) -> DataFrame:
        """One row per partition: tenant (and bucket) and the version and try that hold it."""
        fields = [T.StructField(self.tenant, T.StringType())]
        fields += [T.StructField(BUCKET, T.IntegerType())] if self.bucketed else []
        schema = T.StructType([*fields, T.StructField(VERSION, T.IntegerType()), T.StructField(TRY, T.StringType())])
        return self.spark.read.schema(schema).parquet(f"{self.path}/parts/{self.version}-{self.attempt}")

    def folders(self, parts: DataFrame) -> list:
        """Version, try, tenant folder (and bucket) of each partition in ``parts``: one small row a partition."""
        return parts.withColumn("_tenant", _folder(self.tenant)).select(*self._by).distinct().collect()

    @property
    def _by(self) -> list[str]:
        return [VERSION, TRY, "_tenant", *([BUCKET] if self.bucketed else [])]

    def rows(self, parts: DataFrame) -> DataFrame:
        """The stored rows of the partitions in ``parts`` (as :meth:`parts` has them).

        The scan lists the versions that hold them and prunes by one set test on
        the partition columns, however many there are.
        """
        names, by = [f.name for f in self.schema.fields], self._by
        kinds = {VERSION: T.IntegerType(), TRY: T.StringType(), "_tenant": T.StringType(), BUCKET: T.IntegerType()}
        schema = T.StructType([*self.schema.fields, *[T.StructField(c, kinds[c]) for c in by]])
        listed = self.folders(parts)
        if not listed:
            return self.spark.createDataFrame([], self.schema)
        held = sorted({f"{self.path}/data/{VERSION}={r[VERSION]}/{TRY}={r[TRY]}" for r in listed})
        stored = self.spark.read.schema(schema).option("basePath", f"{self.path}/data").parquet(*held)
        wanted = ", ".join(_quoted("/".join(str(r[c]) for c in by)) for r in listed)
        test = F.expr(f"concat_ws('/', {', '.join(f'CAST({c} AS STRING)' for c in by)}) IN ({wanted})")
        return stored.filter(test).select(*names)


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _folder(tenant: str) -> Column:
    """Name of a tenant's folder; a null tenant and an empty one have folders of their own."""
    return F.coalesce(F.concat(F.lit("t_"), tenant_key(tenant)), F.lit("null"))


def _table_path(path: str, name: str) -> str:
    return f"{path}/{name}" if name else path


def _open(spark: SparkSession, path: str, state: dict, name: str) -> Table:
    found = state["tables"].get(name)
    if found is None:
        raise ValueError(f"no published table{f' {name!r}' if name else ''} at {path}")
    schema = T.StructType.fromJson(found["schema"])
    return Table(spark, _table_path(path, name), found["version"], found["try"], schema, found["tenant"], found["bucketed"])


def open_table(spark: SparkSession, path: str, name: str = "", commit: int | None = None) -> Table:
    """A table as the newest commit, or an earlier one, left it."""
    n = latest_commit(spark, path) if commit is None else commit
    return _open(spark, path, _state(spark, path, n), name)


def read_snapshot(
    spark: SparkSession, path: str, touched: DataFrame | None = None, name: str = "", commit: int | None = None
) -> DataFrame:
    """The published rows, or those in the partitions ``touched`` (tenant and, if bucketed, bucket)."""
    return _rows_of(open_table(spark, path, name, commit), touched)


def _rows_of(table: Table, touched: DataFrame | None) -> DataFrame:
    parts = table.parts()
    if touched is not None:
        parts = parts.join(touched, _same(parts, touched, table.part_cols), "left_semi")
    return table.rows(parts)


def _same(x: DataFrame, y: DataFrame, cols: list[str]) -> Column:
    """Null-safe equality on ``cols``."""
    return reduce(lambda a, b: a & b, [x[c].eqNullSafe(y[c]) for c in cols])


def _with_bucket(df: DataFrame, key: Column | None, buckets: int) -> DataFrame:
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")) if buckets else df


def touched_parts(table: Table, rows: DataFrame, key: Column | None, buckets: int) -> DataFrame:
    """The distinct partitions that rows of a batch fall in, as a written table."""
    own = _with_bucket(rows, key, buckets).withColumn(table.tenant, tenant_key(table.tenant))
    return written_once(own.select(*table.part_cols).distinct(), "touched")


def fingerprint_of(df: DataFrame) -> str:
    """Order-free fingerprint of a batch's rows (a null is not a value that is missing)."""
    cols = sorted(df.columns)
    h = F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in cols], *[F.col(f"`{c}`").isNull() for c in cols])
    row = df.agg(F.count("*").alias("n"), F.sum(h.cast("decimal(38,0)")).alias("s")).first()
    return f"{row['n']}:{row['s'] or 0}"


# ------------------------------------------------------------------ writing


def _write_version(table: Table, version: int, attempt: str, rows: DataFrame, touched: DataFrame | None) -> None:
    """The rows of the touched partitions (all, when None) and the list of partitions of ``version``."""
    by = ["_tenant", BUCKET] if table.bucketed else ["_tenant"]
    # The folder's name folds letter case; the tenant stays in the rows as it is.
    stored = rows.withColumn("_tenant", _folder(table.tenant))
    # Rows of a partition meet in one task, or in as many as its size asks for (a hot tenant is split).
    stored = stored.hint("rebalance", *by)
    path = f"{table.path}/data/{VERSION}={version}/{TRY}={attempt}"
    stored.write.mode("overwrite").partitionBy(*by).parquet(path)
    new = _written_parts(table, path).withColumns({VERSION: F.lit(version), TRY: F.lit(attempt)})
    if touched is not None and table.version:
        old = table.parts()
        new = old.join(touched, _same(old, touched, table.part_cols), "left_anti").unionByName(new)
    new.coalesce(8).write.mode("overwrite").parquet(f"{table.path}/parts/{version}-{attempt}")


def _written_parts(table: Table, path: str) -> DataFrame:
    """Tenant (and bucket) of the partitions in a version's folder, from the folders' names alone."""
    spark, found = table.spark, []
    for folder in _names(spark, path):
        if not folder.startswith("_tenant="):
            continue
        name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder[8:])
        tenant = name[2:] if name.startswith("t_") else None
        inner = [n for n in _names(spark, f"{path}/{folder}") if n.startswith(f"{BUCKET}=")] if table.bucketed else [None]
        found += [(tenant, int(n[len(BUCKET) + 1 :])) if n else (tenant,) for n in inner]
    fields = f"`{table.tenant}` string" + (f", {BUCKET} int" if table.bucketed else "")
    return spark.createDataFrame(found, fields)


def _entry(table: Table, version: int, attempt: str) -> dict:
    kind = json.loads(table.schema.json())
    return {"version": version, "try": attempt, "schema": kind, "tenant": table.tenant, "bucketed": table.bucketed}


def _write_feed(df: DataFrame, path: str, version: int, attempt: str, batch_id: int, run_id: str) -> str:
    """Change or archive rows of a commit, with their batch; returns the folder below ``path``."""
    folder = f"{COMMIT}={version}/{TRY}={attempt}"
    marked = df.withColumns({"batch_id": F.lit(batch_id).cast("long"), "run_id": F.lit(run_id)})
    marked.write.mode("overwrite").parquet(f"{path}/{folder}")
    return folder


def create_snapshot(
    spark: SparkSession, df: DataFrame, path: str, key: Column | None = None, buckets: int = 0, tenant: str = TENANT, name: str = ""
) -> None:
    """Publish ``df`` as the first version of a table (an error where one is already).

    Tables that are created under one ``path`` with different names are committed together.
    """
    if buckets and key is None:
        raise ValueError("a bucketed layout needs the key expression")
    for _ in range(ATTEMPTS):
        state = _state(spark, path, latest_commit(spark, path))
        if name in state["tables"] or (state["tables"] and ("" in state["tables"] or not name)):
            raise ValueError(f"{path} is published already")
        version, attempt = state["commit"] + 1, uuid.uuid4().hex[:12]
        table = Table(spark, _table_path(path, name), 0, "", df.schema, tenant, bool(buckets))
        _write_version(table, version, attempt, _with_bucket(df, key, buckets), None)
        tables = {**state["tables"], name: _entry(table, version, attempt)}
        if _commit(spark, path, {"commit": version, "tables": tables, "feeds": {}}):
            return
    raise ConcurrentCommit(path)


#: What a table's touched partitions become, and its change rows, if any.
Change = tuple[DataFrame, DataFrame | None]


@dataclass(frozen=True)
class Touch:
    """The partitions of one table that a batch touches: those that ``rows`` fall in."""

    rows: DataFrame
    key: Column | None = None
    buckets: int = 0
    feed: str | None = None


def publish_tables(
    spark: SparkSession,
    path: str,
    batch_id: int,
    batch: DataFrame,
    touches: dict[str, Touch],
    change: Callable[[dict[str, DataFrame]], dict[str, Change]],
    run_id: str = "",
) -> bool:
    """Apply one batch to several tables in one commit; False when it was committed before.

    ``change`` gets each table's rows in its touched partitions and returns what
    they become, and change rows for the table's ``feed``.  Should another
    writer's commit come first, it is called again with the newer rows.
    """
    fingerprint = fingerprint_of(batch)
    touched: dict[str, DataFrame] = {}
    for _ in range(ATTEMPTS):
        if _committed(spark, path, batch_id, run_id, fingerprint):
            return False
        state = _state(spark, path, latest_commit(spark, path))
        tables = {name: _open(spark, path, state, name) for name in touches}
        for name, t in touches.items():
            if tables[name].bucketed != bool(t.buckets):
                raise ValueError(f"{tables[name].path} is {'' if tables[name].bucketed else 'not '}bucketed")
            if name not in touched:
                touched[name] = touched_parts(tables[name], t.rows, t.key, t.buckets)
        changed = change({name: _rows_of(tables[name], touched[name]) for name in touches})
        version, attempt = state["commit"] + 1, uuid.uuid4().hex[:12]
        entries, feeds = dict(state["tables"]), {}
        for name, (snapshot, delta) in changed.items():
            table, t = tables[name], touches[name]
            snapshot = snapshot.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields])
            _write_version(table, version, attempt, _with_bucket(snapshot, t.key, t.buckets), touched[name])
            entries[name] = _entry(table, version, attempt)
            if delta is not None and t.feed is not None:
                feeds[t.feed] = _write_feed(delta, t.feed, version, attempt, batch_id, run_id)
        if _finish(spark, path, version, entries, feeds, batch_id, run_id, fingerprint):
            return True
    raise ConcurrentCommit(f"batch {batch_id} of run {run_id!r} at {path}")


def _finish(spark, path, version, tables, feeds, batch_id, run_id, fingerprint) -> bool:
    """Note where the batch goes, then commit; False when another commit came first."""
    _write(spark, _batch_file(path, run_id, batch_id), json.dumps({"commit": version}))
    state = {
        "commit": version, "tables": tables, "feeds": feeds, "batch_id": batch_id, "run_id": run_id, "fingerprint": fingerprint,
    }
    return _commit(spark, path, state)


def publish(
    spark: SparkSession,
    path: str,
    batch_id: int,
    batch: DataFrame,
    change: Callable[[DataFrame], Change],
    delta_path: str | None = None,
    key: Column | None = None,
    buckets: int = 0,
    run_id: str = "",
) -> bool:
    """Apply one batch to the table at ``path``; False when it was committed before.

    ``batch`` names the touched partitions (by tenant, and by the bucket of
    ``key`` when ``buckets`` > 0); ``change`` gets the snapshot rows of these
    partitions and returns what they become, and the change rows, if any.
    ``run_id`` tells apart runs that count their batches from 0 again, such as
    streams with different checkpoints.
    """
    touch = Touch(batch, key, buckets, delta_path)
    return publish_tables(spark, path, batch_id, batch, {"": touch}, lambda rows: {"": change(rows[""])}, run_id)


def publish_purge(
    spark: SparkSession, path: str, tenant_id: str, batch_id: int, archive: DataFrame | None = None,
    archive_path: str | None = None, run_id: str = "purge", name: str = "",
) -> bool:
    """Remove a tenant (any letter case) from a table: its partitions leave the list, no file is rewritten.

    ``archive`` rows, if any, become readable at ``archive_path`` (:func:`read_feed`)
    with the commit.  The files go with the next :func:`sweep` that no longer
    keeps a commit that lists them.
    """
    for _ in range(ATTEMPTS):
        if _committed(spark, path, batch_id, run_id, tenant_id.lower()):
            return False
        state = _state(spark, path, latest_commit(spark, path))
        table = _open(spark, path, state, name)
        version, attempt = state["commit"] + 1, uuid.uuid4().hex[:12]
        kept = table.parts().filter(~F.col(table.tenant).eqNullSafe(F.lit(tenant_id.lower())))
        kept.write.mode("overwrite").parquet(f"{table.path}/parts/{version}-{attempt}")
        feeds = {}
        if archive is not None:
            feeds[archive_path] = _write_feed(archive, archive_path, version, attempt, batch_id, run_id)
        entries = {**state["tables"], name: _entry(table, version, attempt)}
        if _finish(spark, path, version, entries, feeds, batch_id, run_id, tenant_id.lower()):
            return True
    raise ConcurrentCommit(f"purge {batch_id} at {path}")


# ------------------------------------------------------------------ feeds


def _feed_folders(spark: SparkSession, path: str, feed_path: str, after: int, upto: int | None) -> list[str]:
    """Folders of the feed's committed rows, for the commits ``after`` < n <= ``upto``."""
    commits = spark.read.schema("commit int, feeds map<string, string>").json(f"{path}/commits/*.json")
    wanted = F.col("commit") > after if upto is None else F.col("commit").between(after + 1, upto)
    found = commits.filter(wanted).select("commit", F.col("feeds")[feed_path].alias("folder")).filter("folder IS NOT NULL")
    return [r.folder for r in found.orderBy("commit").collect()]


def read_feed(
    spark: SparkSession, path: str, feed_path: str, after: int = 0, upto: int | None = None, with_commit: bool = False
) -> DataFrame | None:
    """Committed change or archive rows of the commits ``after`` < n <= ``upto``, with ``batch_id`` and ``run_id``.

    One scan of these commits' folders, however many; rows that were written and
    never committed stay out.  None when no such commit has rows.  A consumer
    that remembers :func:`latest_commit` reads every row once.
    """
    folders = _feed_folders(spark, path, feed_path, after, upto)
    if not folders:
        return None
    rows = spark.read.option("basePath", feed_path).parquet(*[f"{feed_path}/{f}" for f in folders]).drop(TRY)
    return rows if with_commit else rows.drop(COMMIT)


def read_delta(spark: SparkSession, path: str, delta_path: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """The committed change rows (:func:`read_feed`); an error when there are none."""
    rows = read_feed(spark, path, delta_path, after, upto)
    if rows is None:
        raise ValueError(f"no committed change rows at {delta_path}")
    return rows


# ------------------------------------------------------------------ retention


def sweep(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete every file that none of the last ``keep`` commits reaches; returns the folders deleted.

    Reachable are the partitions that these commits list; a version whose other
    partitions are still in use loses only the unreachable ones, so the rows of
    a purged tenant are gone from the disk.  Readers of the kept commits are not
    disturbed, nor is a writer at work: files of commits to come stay.  The
    commits themselves (state and feeds, no rows) are kept for the feeds' readers.
    """
    last = latest_commit(spark, path)
    kept = [_state(spark, path, n) for n in range(max(1, last - max(1, keep) + 1), last + 1)]
    gone: list[str] = []
    for name in sorted({name for state in kept for name in state["tables"]}):
        tables = {(t.version, t.attempt): t for t in (_open(spark, path, s, name) for s in kept if name in s["tables"])}
        table = next(iter(tables.values()))
        live: dict[str, set[str]] = {}
        for t in tables.values():
            for r in t.folders(t.parts()):
                inner = f"_tenant={_escaped(spark, r['_tenant'])}" + (f"/{BUCKET}={r[BUCKET]}" if t.bucketed else "")
                live.setdefault(f"{VERSION}={r[VERSION]}/{TRY}={r[TRY]}", set()).add(inner)
        for version in _names(spark, f"{table.path}/data"):
            if not version.startswith(f"{VERSION}=") or int(version[len(VERSION) + 1 :]) > last:
                continue
            for attempt in _names(spark, f"{table.path}/data/{version}"):
                gone += _swept(spark, f"{table.path}/data", f"{version}/{attempt}", live.get(f"{version}/{attempt}", set()))
        for folder in _names(spark, f"{table.path}/parts"):
            number, _, attempt = folder.partition("-")
            if number.isdigit() and int(number) <= last and (int(number), attempt) not in tables:
                gone.append(f"{table.path}/parts/{folder}")
    for folder in gone:
        _delete(spark, folder)
    return gone


def _escaped(spark: SparkSession, name: str) -> str:
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(name)


def _swept(spark: SparkSession, data: str, version: str, live: set[str]) -> list[str]:
    """Folders of one version to delete: the whole, or the partitions that are not live."""
    if not live:
        return [f"{data}/{version}"]
    out = []
    tenants = {p.split("/")[0] for p in live}
    for tenant in _names(spark, f"{data}/{version}"):
        if not tenant.startswith("_tenant="):
            continue
        if tenant not in tenants:
            out.append(f"{data}/{version}/{tenant}")
        elif tenant not in live:  # buckets below
            inner = _names(spark, f"{data}/{version}/{tenant}")
            out += [f"{data}/{version}/{tenant}/{b}" for b in inner if b.startswith(BUCKET) and f"{tenant}/{b}" not in live]
    return out
