"""Versioned tables on plain files with an all-or-nothing commit.

A version is one small JSON file that lists, per table, the folders holding its rows and the
largest surrogate key given so far. Data folders are written first and are never touched again; the version appears when its
JSON file, written and closed under another name, is renamed to its own, which fails if another writer took the number. Readers see
the old version or the new one, never a mixture or an unfinished file, and a failed load leaves the old one in place.
"""

from __future__ import annotations

import copy
import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from starloom.operators import keyfilter
from starloom.schemas import WAREHOUSE
from starloom.session import Scratch

_PART = "_period"
GRAINS = {"year": 10000, "month": 100}
_VERSION = re.compile(r"\d{8}\.json")
_FEW = 64  # one key in so many is asked first


def empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


class Store:
    """A warehouse folder. Facts are laid out by purchase period so a reload rewrites few of them.

    The length of the periods, ``grain``, is chosen with the first version and stored in it: a year
    unless given. One changed line rewrites its period, so months suit frequent small corrections. Another grain later is an error.
    """

    def __init__(self, spark: SparkSession, root: str, grain: str | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        if grain is not None and grain not in GRAINS:
            raise ValueError(f"grain {grain!r} is none of {', '.join(GRAINS)}")
        self._grain = grain

    def grain(self, manifest: dict) -> str:
        """Stored grain of the warehouse, or the one it is about to get."""
        known = manifest.get("grain")
        if known and self._grain and known != self._grain:
            raise ValueError(f"{self.root} is laid out by {known}, not by {self._grain}")
        return known or self._grain or "year"

    # Version files -------------------------------------------------------------------
    def _fs(self, path: str):
        hadoop_path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return hadoop_path, hadoop_path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        path, fs = self._fs(f"{self.root}/_versions")
        if not fs.exists(path):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        return sorted(int(name.split(".")[0]) for name in names if _VERSION.fullmatch(name))

    def manifest(self, version: int | None = None) -> dict:
        """Folders of every table in ``version`` (the newest by default)."""
        known = self.versions()
        if version is None:
            if not known:
                return {"version": 0, "tables": {}, "keys": {}}
            version = known[-1]
        text = self.spark.read.option("wholetext", True).text(f"{self.root}/_versions/{version:08d}.json").first()[0]
        return json.loads(text)

    def read(self, table: str, manifest: dict | None = None, periods: list[int] | None = None, parts: set[str] | None = None) -> DataFrame:
        """Rows of ``table``, of a fact optionally only some ``periods`` or some ``parts``; empty if never loaded."""
        manifest = manifest or self.manifest()
        schema = WAREHOUSE[table].schema
        paths = []
        for entry in manifest["tables"].get(table, []):
            base = f"{self.root}/{entry['path']}"
            if entry["parts"] is None:
                paths.append(base)
            else:
                paths += [f"{base}/{_PART}={p}" for p in entry["parts"] if (periods is None or p in periods) and (parts is None or _part(entry, p) in parts)]
        if not paths:
            return empty(self.spark, schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def tables(self, manifest: dict | None = None) -> dict[str, DataFrame]:
        manifest = manifest or self.manifest()
        return {name: self.read(name, manifest) for name in WAREHOUSE}

    def register_views(self, prefix: str = "dw_", manifest: dict | None = None) -> list[str]:
        """Temporary views ``dw_<table>`` of one version, for queries written as SQL; returns their names."""
        tables = self.tables(manifest)
        for name, df in tables.items():
            df.createOrReplaceTempView(f"{prefix}{name}")
        return [f"{prefix}{name}" for name in tables]

    # Upkeep --------------------------------------------------------------------------
    def compact(self, most: int = 1) -> int:
        """Rewrite every period of a fact, and every dimension, that lies in more than ``most`` folders into one folder, as a new version.

        Rows and keys stay as they are. Returns the version, or the present one where nothing had to move.
        """
        draft = self.draft()
        moved = False
        for table in WAREHOUSE:
            entries = draft.entries(table)
            if any(entry["parts"] is None for entry in entries):
                if len(entries) > most:
                    draft.rewrite(table)
                    moved = True
                continue
            folders: dict[int, int] = {}
            for entry in entries:
                for period in entry["parts"]:
                    folders[period] = folders.get(period, 0) + 1
            scattered = sorted(period for period, n in folders.items() if n > most)
            if scattered:
                draft.replace_periods(table, draft.read(table, scattered), scattered)
                moved = True
        return draft.commit() if moved else draft.base

    def vacuum(self, keep: int = 1) -> list[str]:
        """Remove all but the newest ``keep`` versions and every folder that no kept version lists; returns the folders removed.

        Folders of refused loads go as well. A draft in progress writes below the number after the newest version, which is left alone.
        """
        if keep < 1:
            raise ValueError("at least one version is kept")
        known = self.versions()
        if not known:
            return []
        used: set[str] = set()
        for version in known[-keep:]:
            for entries in self.manifest(version)["tables"].values():
                used |= {path for entry in entries for path in (entry["path"], entry.get("keys")) if path}
        for version in known[:-keep]:  # versions first: no reader is led to a folder that goes
            path, fs = self._fs(f"{self.root}/_versions/{version:08d}.json")
            fs.delete(path, False)
        data, fs = self._fs(f"{self.root}/data")
        gone = []
        for load in fs.listStatus(data):
            number = load.getPath().getName()
            if int(number) > known[-1]:
                continue
            inside = [folder.getPath() for folder in fs.listStatus(load.getPath())]
            unused = [path for path in inside if f"data/{number}/{path.getName()}" not in used]
            gone += [f"data/{number}/{path.getName()}" for path in unused]
            for path in [load.getPath()] if len(unused) == len(inside) else unused:
                fs.delete(path, True)
        return sorted(gone)

    # Drafts --------------------------------------------------------------------------
    def draft(self) -> "Draft":
        manifest = copy.deepcopy(self.manifest())
        manifest["grain"] = self.grain(manifest)
        return Draft(self, manifest)


def _part(entry: dict, period: int) -> str:
    return f"{entry['path']}/{_PART}={period}"


def _has_filter(entry: dict) -> bool:
    """Whether a filter of the present layout lies beside the folder; earlier layouts count as none."""
    return bool(entry.get("keys")) and entry.get("bitmaps") == keyfilter.HASHES


class Draft:
    """The next version while it is being written."""

    def __init__(self, store: Store, manifest: dict):
        self.store = store
        self.manifest = manifest
        self.base = manifest["version"]
        self.folder = f"data/{self.base + 1:08d}"
        self.scratch = Scratch(store.spark)
        self.stored = {table: [entry["path"] for entry in entries] for table, entries in manifest["tables"].items()}

    def read(self, table: str, periods: list[int] | None = None, parts: set[str] | None = None) -> DataFrame:
        return self.store.read(table, self.manifest, periods, parts)

    def fresh(self, table: str) -> DataFrame:
        """Rows in folders that this draft has written; rewritten periods are among them."""
        return self.store.read(table, {"tables": {table: [e for e in self.entries(table) if not self._is_old(table, e)]}})

    def earlier(self, table: str) -> DataFrame:
        """Rows in folders that earlier versions wrote."""
        return self.store.read(table, {"tables": {table: [e for e in self.entries(table) if self._is_old(table, e)]}})

    def _is_old(self, table: str, entry: dict) -> bool:
        return entry["path"] in self.stored.get(table, [])

    def kept_rows(self, table: str) -> int | None:
        """Number of rows in folders that earlier versions wrote; None where a folder has no count."""
        own = [entry for entry in self.entries(table) if self._is_old(table, entry)]
        if any("rows" not in entry for entry in own):
            return None
        return sum(e["rows"] if e["parts"] is None else sum(e["rows"][str(p)] for p in e["parts"]) for e in own)

    def may_hold(self, table: str, rows: DataFrame, stored_only: bool = False) -> set[str]:
        """Parts of a fact that may hold natural keys of ``rows``, by their key ranges and filters; a part without a filter always may."""
        spec = WAREHOUSE[table]
        keys = [F.col(k).cast(spec.schema[k].dataType) for k in spec.natural_key]
        entries = [e for e in self.entries(table) if not stored_only or self._is_old(table, e)]
        asked = [
            {"part": _part(e, p), "entry": e, **e["filters"][str(p)]} for e in entries for p in e["parts"] if _has_filter(e)
        ]
        found = {_part(e, p) for e in entries for p in e["parts"] if not _has_filter(e)}
        if asked:
            low, high = rows.agg(F.min(keys[0]), F.max(keys[0])).first()
            asked = [p for p in asked if low is not None and p["low"] <= high and low <= p["high"]]
        if asked:
            paths = sorted({f"{self.store.root}/{p['entry']['keys']}" for p in asked})
            filters = self.store.spark.read.schema(keyfilter.FILTER_SCHEMA).parquet(*paths)
            # One hit admits a part: those that a few keys already hit are not asked for all the others.
            for one_in in (_FEW, 1):
                hit = {row.part for row in keyfilter.probe(rows, keys, asked, filters, one_in).collect()} if asked else set()
                asked = [p for p in asked if p["part"] not in hit]
                found |= hit
        return found

    def period(self):
        """Number of the period a row belongs to."""
        return (F.col("date_key") / GRAINS[self.manifest["grain"]]).cast("int")

    def holds(self, table: str) -> bool:
        return bool(self.manifest["tables"].get(table))

    def _folder_for(self, table: str) -> str:
        return f"{self.folder}/{table}-{uuid.uuid4().hex[:8]}"

    def entries(self, table: str) -> list[dict]:
        return self.manifest["tables"].setdefault(table, [])

    def last_key(self, table: str) -> int:
        """Largest surrogate key stored in ``table``; known without reading it."""
        return self.manifest["keys"].get(table, 0)

    def _measure(self, table: str, path: str) -> int:
        """Rows in a folder just written; notes their largest key."""
        spec = WAREHOUSE[table]
        written = self.store.spark.read.schema(spec.schema).parquet(f"{self.store.root}/{path}")
        rows, key = written.agg(F.count(F.lit(1)), F.max(spec.key)).first()
        if rows:
            self.manifest["keys"][table] = max(key, self.last_key(table))
        return rows

    def append(self, table: str, rows: DataFrame) -> int:
        """Add rows to a table without periods; returns how many there were."""
        path = self._folder_for(table)
        rows.write.parquet(f"{self.store.root}/{path}")
        written = self._measure(table, path)
        if written:
            self.entries(table).append({"path": path, "parts": None, "rows": written})
        return written

    def rewrite(self, table: str) -> None:
        """Put all rows of a table without periods into one folder."""
        rows = self.read(table)
        self.manifest["tables"][table] = []
        self.append(table, rows.repartitionByRange(WAREHOUSE[table].key))

    def _filtered(self, table: str, path: str) -> dict:
        """Entry of a fact folder just written: rows, key range and key filter of every period; notes the largest surrogate key."""
        spec = WAREHOUSE[table]
        schema = StructType([*spec.schema.fields, StructField(_PART, IntegerType())])
        written = self.store.spark.read.schema(schema).parquet(f"{self.store.root}/{path}")
        first = spec.natural_key[0]
        # Beside a collected set, least and greatest texts are kept in a hash table too; alone they would sort the rows.
        measures = [F.count(F.lit(1)).alias("n"), F.max(spec.key).alias("key"), F.min(first).alias("low"), F.max(first).alias("high"), F.collect_set(_PART).alias("periods")]
        stats = written.groupBy(_PART).agg(*measures).collect()
        filters = {str(r[_PART]): {"blocks": keyfilter.blocks_for(r["n"]), "low": r["low"], "high": r["high"]} for r in stats}
        blocks = {r[_PART]: filters[str(r[_PART])]["blocks"] for r in stats}
        keyfilter.build(written, _PART, f"{path}/{_PART}=", [F.col(k) for k in spec.natural_key], blocks).write.parquet(f"{self.store.root}/{path}-keys")
        self.manifest["keys"][table] = max(self.last_key(table), *[r["key"] for r in stats])
        return {"path": path, "parts": sorted(map(int, filters)), "rows": {str(r[_PART]): r["n"] for r in stats}, "keys": f"{path}-keys", "bitmaps": keyfilter.HASHES, "filters": filters}

    def replace_periods(self, table: str, rows: DataFrame, replaced: list[int]) -> None:
        """Store ``rows`` by period and drop the stored periods in ``replaced``.

        Spark balances the output files itself: a large period is split, small ones share a task. A filter of the keys is written beside them.
        """
        path = self._folder_for(table)
        placed = rows.withColumn(_PART, self.period()).hint("rebalance", F.col(_PART))
        placed.write.partitionBy(_PART).parquet(f"{self.store.root}/{path}")
        hadoop_path, fs = self.store._fs(f"{self.store.root}/{path}")
        written = any(s.getPath().getName().startswith(f"{_PART}=") for s in fs.listStatus(hadoop_path))
        kept = []
        for entry in self.entries(table):
            parts = [p for p in entry["parts"] if p not in replaced]
            if parts:
                kept.append({**entry, "parts": parts})
        if written:
            kept.append(self._filtered(table, path))
        self.manifest["tables"][table] = kept

    def commit(self) -> int:
        """Publish the draft; raises if somebody else published a version in the meantime."""
        version = self.base + 1
        self.manifest["version"] = version
        jvm = self.store.spark._jvm
        final, fs = self.store._fs(f"{self.store.root}/_versions/{version:08d}.json")
        unfinished = jvm.org.apache.hadoop.fs.Path(f"{self.store.root}/_versions/.{version:08d}-{uuid.uuid4().hex}")
        stream = fs.create(unfinished, False)
        try:
            stream.write(bytearray(json.dumps(self.manifest), "utf-8"))
        finally:
            stream.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(final.toUri(), self.store.spark._jsc.hadoopConfiguration())
        no_overwrite = self.store.spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            files.rename(files.makeQualified(unfinished), files.makeQualified(final), no_overwrite)
        except Exception as error:
            fs.delete(unfinished, False)
            if not fs.exists(final):
                raise
            raise RuntimeError(f"version {version} was committed by another writer") from error
        return version
