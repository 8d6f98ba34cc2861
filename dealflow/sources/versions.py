"""Tables published in versions: data folders by day, and a manifest that says which folder holds each
day. A version is there once its manifest is, which one rename makes visible; readers of the version
before are not disturbed, and days that did not change keep their folder."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The manifest's key of rows without a day, and the folder that Spark writes them to.
NO_DAY, NO_DAY_FOLDER = "", "__HIVE_DEFAULT_PARTITION__"


def digest_columns(df: DataFrame) -> list:
    """Aggregates that are equal for equal bags of rows: the row count, and the sums of two hashes of all
    columns. The hashes also cover which columns are NULL, as hashing skips those."""
    cols = [F.col(f"`{c}`") for c in df.columns]
    hashed = lambda salt: F.xxhash64(F.lit(salt), *cols, *[c.isNull() for c in cols]).cast("decimal(20,0)")
    return [F.count(F.lit(1)).alias("rows"), F.sum(hashed(1)).alias("one"), F.sum(hashed(2)).alias("two")]


class VersionedTable:
    """``root``: the table's folder; ``day``: the date column that rows are filed by (None: one file
    folder for all rows); ``key``: the column that a merge goes by."""

    def __init__(self, spark: SparkSession, root: str, day: str | None, key: str):
        self.spark, self.root, self.day, self.key = spark, root.rstrip("/"), day, key

    # files

    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _names(self, folder: str) -> list[str]:
        fs, p = self._path(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def versions(self) -> list[int]:
        """The numbers of all published versions that are still there."""
        return [int(n[:-5]) for n in self._names("_versions") if n.endswith(".json") and n[:-5].isdigit()]

    def manifest(self, version: int | None = None) -> dict | None:
        """What a version (the newest) says; None where there is none."""
        there = self.versions()
        if not there or (version is not None and version not in there):
            return None
        fs, p = self._path(f"{self.root}/_versions/{version if version is not None else there[-1]:06d}.json")
        stream = fs.open(p)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, parent: dict | None, schema: T.StructType, days: dict, facts: dict) -> dict:
        """Publish the version after ``parent``. A complete file is renamed to the version's name; where
        that name is taken, another writer has published meanwhile and nothing is changed."""
        new = {"version": (parent["version"] if parent else 0) + 1, "schema": schema.jsonValue(), "days": days, "facts": facts}
        fs, at = self._path(f"{self.root}/_versions/{new['version']:06d}.json")
        _, tmp = self._path(f"{self.root}/_versions/_{uuid.uuid4().hex}")
        out = fs.create(tmp, False)
        try:
            out.writeBytes(json.dumps(new))
        finally:
            out.close()
        if fs.exists(at) or not fs.rename(tmp, at):
            fs.delete(tmp, False)
            raise RuntimeError(f"{self.root}: version {new['version']} was published by another writer; build again")
        return new

    # rows

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the newest), as a lazy scan of its folders, pruned by day."""
        m = self.manifest(version)
        if m is None:
            raise FileNotFoundError(f"{self.root} has no version{'' if version is None else f' {version}'}")
        return self._read(m)

    def _folder(self, day: str, entry: dict) -> str:
        part = "" if self.day is None else f"/{self.day}={day or NO_DAY_FOLDER}"
        return f"{self.root}/data/{entry['at']}{part}"

    def _read(self, m: dict, days=None) -> DataFrame:
        schema = T.StructType.fromJson(m["schema"])
        paths = [self._folder(d, e) for d, e in m["days"].items() if days is None or d in days]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths).select(*schema.names)

    def _write(self, df: DataFrame, version: int, partitions: int | None) -> str:
        """``df`` in a folder of its own, which no reader knows yet; the folder's name. Rows are
        range-partitioned by (day, key), so a task writes few days and a full day has several tasks."""
        at = f"v={version:06d}-{uuid.uuid4().hex[:8]}"
        if self.day is not None:
            df = df.repartitionByRange(*([partitions] if partitions else []), self.day, self.key)
        w = df.write if self.day is None else df.write.partitionBy(self.day)
        w.parquet(f"{self.root}/data/{at}")
        return at

    def digests(self, df: DataFrame) -> dict[str, dict]:
        """By day: the digest of its rows. One aggregate; one row a day reaches the driver."""
        day = F.lit(NO_DAY) if self.day is None else F.coalesce(F.col(self.day).cast("string"), F.lit(NO_DAY))
        got = df.groupBy(day.alias("__day")).agg(*digest_columns(df)).collect()
        return {r["__day"]: {"rows": r["rows"], "digest": f"{r['one']},{r['two']}"} for r in got}

    def _on(self, days):
        """Whether a row is on one of ``days``."""
        if self.day is None:
            return F.lit(True)
        dates = [F.lit(d).cast("date") for d in days if d != NO_DAY]
        hit = F.coalesce(F.col(self.day).isin(*dates), F.lit(False)) if dates else F.lit(False)
        return hit | F.col(self.day).isNull() if NO_DAY in days else hit

    def publish(self, df: DataFrame, facts: dict | None = None, partitions: int | None = None) -> dict:
        """Make ``df`` the table. Days whose rows are the published ones, by their digests, keep their
        folder; only others are written, and days without rows go. Without a difference no version
        is made. ``df`` is evaluated twice: give a written table where that is dear."""
        old, facts = self.manifest(), facts or {}
        had = old["days"] if old and old["schema"] == df.schema.jsonValue() else {}
        new = self.digests(df)
        differ = {d for d, e in new.items() if {k: had.get(d, {}).get(k) for k in ("rows", "digest")} != e}
        if old and had and not differ and had.keys() == new.keys() and old["facts"] == facts:
            return old
        at = self._write(df.filter(self._on(differ)) if differ != new.keys() else df, (old["version"] if old else 0) + 1, partitions) if differ else None
        days = {d: {**e, "at": at} if d in differ else had[d] for d, e in sorted(new.items())}
        return self._commit(old, df.schema, days, facts)

    def merge(self, rows: DataFrame, changed: DataFrame, facts: dict | None = None, partitions: int | None = None) -> dict:
        """Replace all rows of the keys in ``changed`` (its column ``key``) by those in ``rows``: keys
        without new rows vanish, and rows that moved leave the day that they were on. Only days that
        lose or get a row are rewritten. Give written tables: both are read several times."""
        old = self.manifest()
        if old is None:
            raise FileNotFoundError(f"{self.root} has no version to merge into")
        if T.StructType.fromJson(old["schema"]).simpleString() != rows.schema.simpleString():
            raise ValueError(f"{self.root}: the columns changed; publish the whole table")
        changed = changed.select(self.key).filter(F.col(self.key).isNotNull()).distinct()
        fresh, published = rows.join(changed, self.key, "left_semi").select(*rows.columns), self._read(old)
        gone = published.join(changed, self.key, "left_semi").select(*rows.columns)
        touched = set(self.digests(gone)) | set(self.digests(fresh))
        if not touched:
            return old
        kept = self._read(old, touched).join(changed, self.key, "left_anti").select(*rows.columns)
        at = self._write(kept.unionByName(fresh), old["version"] + 1, partitions)
        written = self.spark.read.schema(rows.schema).option("basePath", f"{self.root}/data").parquet(f"{self.root}/data/{at}").select(*rows.columns)
        days = {d: e for d, e in old["days"].items() if d not in touched}
        days |= {d: {**e, "at": at} for d, e in self.digests(written).items()}
        return self._commit(old, rows.schema, dict(sorted(days.items())), facts if facts is not None else old["facts"])

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete manifests but the newest ``keep``, and data folders that those don't name. Not while
        another writer is at work: its folder is not named yet. Returns what was deleted."""
        there = self.versions()
        stay = there[-keep:] if keep else []
        used = {e["at"] for v in stay for e in self.manifest(v)["days"].values()}
        goes = [f"_versions/{v:06d}.json" for v in there if v not in stay] + [f"data/{n}" for n in self._names("data") if n not in used]
        for name in goes:
            fs, p = self._path(f"{self.root}/{name}")
            fs.delete(p, True)
        return goes

    def create_view(self, name: str, database: str) -> None:
        """Publish the newest version in the catalog, where every session finds it: a table whose
        partitions are the version's day folders, and a view by the table's name, which moves from
        version to version in one step."""
        m, q = self.manifest(), lambda *n: ".".join(f"`{x}`" for x in n)
        schema = T.StructType.fromJson(m["schema"])
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {q(database)}")
        own = f"{name}__v{m['version']:06d}"
        if not self.spark.catalog.tableExists(f"{database}.{own}"):
            cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            part = "" if self.day is None else f" PARTITIONED BY (`{self.day}`)"
            where = f"{self.root}/data" if self.day is not None else self._folder(NO_DAY, m["days"][NO_DAY]) if m["days"] else f"{self.root}/data/none"
            self.spark.sql(f"CREATE TABLE {q(database, own)} ({cols}) USING parquet{part} LOCATION '{where}'")
            for d, e in m["days"].items() if self.day is not None else ():
                value = f"DATE '{d}'" if d else "NULL"
                self.spark.sql(f"ALTER TABLE {q(database, own)} ADD PARTITION (`{self.day}` = {value}) LOCATION '{self._folder(d, e)}'")
        self.spark.sql(f"CREATE OR REPLACE VIEW {q(database, name)} AS SELECT {', '.join(f'`{c}`' for c in schema.names)} FROM {q(database, own)}")
