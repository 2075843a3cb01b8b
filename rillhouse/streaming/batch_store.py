"""Tables and keyed state that move on micro-batch by micro-batch, all at once.

A job that runs ``each_batch`` writes whatever a batch changes into new folders and then
one commit, a small text that names the folders in force.  Readers follow the newest
commit, so they see a batch with all its outputs or not at all; a batch that runs again is
recognised by its number and changes nothing.  What no recent commit names is removed
later, so a reader that has started keeps its files.

    commits/<number>.json
    tables/<name>/<number>-<token>/[_day=<day>/]             appended rows
    state/<name>/<number>-<token>/bucket=<b>/                rows by key, newest version

* **State** is kept in buckets of its key.  A batch reads and rewrites only the buckets that
  its keys fall into, and those that hold rows which are due to expire: the commit keeps
  each bucket's oldest time as a timer.
* **Tables** may be kept by day.  The commit is their index: a report reads one day's
  folders without listing the others.  ``compact`` folds a day's folders into one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EMPTY = {"number": -1, "batch": -1, "tables": {}, "state": {}, "marks": {}}


class BatchStore:
    """The tables and states of one job; one job writes, any number of readers read."""

    def __init__(self, spark: SparkSession, path: str, keep: int = 2):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self._jvm = spark._jvm
        self._fs = self._at("").getFileSystem(spark._jsc.hadoopConfiguration())

    # -------------------------------------------------------------- files

    def _at(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}".rstrip("/"))

    def _names(self, folder: str) -> list[str]:
        if not self._fs.exists(self._at(folder)):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._at(folder))]

    def _read(self, name: str) -> str:
        stream = self._fs.open(self._at(name))
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def _write_new(self, name: str, text: str) -> bool:
        """Appears complete or not at all; False if it is there already."""
        draft = self._at(f"{name}.{uuid.uuid4().hex}.tmp")
        out = self._fs.create(draft, False)
        out.write(text.encode())
        out.close()
        if self._fs.exists(self._at(name)) or not self._fs.rename(draft, self._at(name)):
            self._fs.delete(draft, False)
            return False
        return True

    # -------------------------------------------------------------- commits

    def _numbers(self) -> list[int]:
        return sorted(int(n[:-5]) for n in self._names("commits") if n.endswith(".json"))

    def last(self) -> dict:
        """The newest commit."""
        numbers = self._numbers()
        return json.loads(self._read(f"commits/{numbers[-1]}.json")) if numbers else json.loads(json.dumps(EMPTY))

    def begin(self, batch_id: int) -> Batch | None:
        """The turn of a micro-batch, or None if it has been committed."""
        before = self.last()
        return None if batch_id <= before["batch"] else Batch(self, before, batch_id)

    def _commit(self, after: dict) -> bool:
        if not self._write_new(f"commits/{after['number']}.json", json.dumps(after)):
            return False
        self._clean(after["number"])
        return True

    def _clean(self, number: int) -> None:
        """Old commits go, and the folders that no commit left names.  Folders of writers at
        work have numbers that are not committed yet and stay."""
        numbers = self._numbers()
        for old in numbers[:-self.keep]:
            self._fs.delete(self._at(f"commits/{old}.json"), False)
        named: set[str] = set()
        for kept in numbers[-self.keep:]:
            commit = json.loads(self._read(f"commits/{kept}.json"))
            named |= {e["folder"] for entries in commit["tables"].values() for e in entries}
            named |= {b["folder"] for s in commit["state"].values() for b in s["buckets"].values()}
        versions = {f"{folder.split('/bucket=')[0]}" for folder in named}
        for kind in ("tables", "state"):
            for name in self._names(kind):
                for version in self._names(f"{kind}/{name}"):
                    folder = f"{kind}/{name}/{version}"
                    if int(version.split("-")[0]) > number:
                        continue
                    if folder not in versions:
                        self._fs.delete(self._at(folder), True)
                    elif kind == "state":
                        for bucket in self._names(folder):
                            if bucket.startswith("bucket=") and f"{folder}/{bucket}" not in named:
                                self._fs.delete(self._at(f"{folder}/{bucket}"), True)

    # -------------------------------------------------------------- reading

    def table(self, name: str, schema: str, days: Iterable[str] | None = None,
              commit: dict | None = None) -> DataFrame:
        """Committed rows of a table; with ``days`` only their folders are listed and read."""
        wanted = None if days is None else set(days)
        paths = []
        for entry in (commit or self.last())["tables"].get(name, []):
            if not entry["days"]:
                paths.append(entry["folder"])
            else:
                paths += [f"{entry['folder']}/_day={d}" for d in entry["days"] if wanted is None or d in wanted]
        return self._frame(paths, schema)

    def days(self, name: str) -> list[str]:
        """Days that a table holds, oldest first."""
        return sorted({d for e in self.last()["tables"].get(name, []) for d in e["days"]})

    def state(self, name: str, schema: str, buckets: Iterable[int] | None = None,
              commit: dict | None = None) -> DataFrame:
        """Committed rows of a state, of some buckets or of all, without their bucket."""
        known = (commit or self.last())["state"].get(name, {"buckets": {}})["buckets"]
        wanted = set(known) if buckets is None else {str(b) for b in buckets}
        return self._frame([known[b]["folder"] for b in sorted(known) if b in wanted], schema)

    def _frame(self, paths: list[str], schema: str) -> DataFrame:
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.path}/{p}" for p in paths])

    # -------------------------------------------------------------- compaction

    def compact(self, name: str, schema: str, day: str, files: int = 1) -> bool:
        """Fold a day's folders into one; False if there was nothing to fold or a batch was
        committed meanwhile (try again)."""
        before = self.last()
        entries = before["tables"].get(name, [])
        mine = [e for e in entries if day in e["days"]]
        if len(mine) < 2:
            return False
        rows = self.table(name, schema, [day], commit=before)
        number = before["number"] + 1
        folder = f"tables/{name}/{number}-{uuid.uuid4().hex[:8]}"
        rows.coalesce(files).write.parquet(f"{self.path}/{folder}/_day={day}")
        left = [{**e, "days": [d for d in e["days"] if d != day]} for e in entries]
        after = {**before, "number": number, "tables": {
            **before["tables"], name: [e for e in left if e["days"]] + [{"folder": folder, "days": [day]}]}}
        return self._commit(after)


class Batch:
    """What one micro-batch writes; nothing of it is visible before ``commit``."""

    def __init__(self, store: BatchStore, before: dict, batch_id: int):
        self.store, self.before, self.number = store, before, before["number"] + 1
        self.after = json.loads(json.dumps(before)) | {"number": self.number, "batch": batch_id}

    def _folder(self, kind: str, name: str) -> str:
        return f"{kind}/{name}/{self.number}-{uuid.uuid4().hex[:8]}"

    def append(self, name: str, rows: DataFrame, by: str | None = None) -> DataFrame:
        """Add rows to a table, in folders of the day column ``by`` if one is given; returns
        them as they were written."""
        folder = self._folder("tables", name)
        path = f"{self.store.path}/{folder}"
        days: list[str] = []
        if by is None:
            rows.write.parquet(path)
        else:
            rows.withColumn("_day", F.col(by).cast("string")).write.partitionBy("_day").parquet(path)
            days = sorted(n.split("=", 1)[1] for n in self.store._names(folder) if n.startswith("_day="))
        if by is None or days:
            self.after["tables"].setdefault(name, []).append({"folder": folder, "days": days})
        paths = [f"{path}/_day={d}" for d in days] if by else [path]
        return self.store.spark.read.schema(rows.schema).parquet(*paths) if paths else rows.limit(0)

    def due(self, name: str, before: int | None) -> set[int]:
        """Buckets whose oldest row lies at or before a time."""
        known = self.before["state"].get(name, {"buckets": {}})["buckets"]
        return set() if before is None else {
            int(b) for b, e in known.items() if e["oldest"] is not None and e["oldest"] <= before}

    def state(self, name: str, schema: str, buckets: Iterable[int]) -> DataFrame:
        """Rows of some buckets before this batch."""
        return self.store.state(name, schema, buckets, commit=self.before)

    def put_state(self, name: str, rows: DataFrame, buckets: list[int], oldest: Column,
                  dealt: bool = False) -> None:
        """The rows that ``buckets`` hold from now on; ``rows`` has the column ``bucket`` and
        may be ``dealt`` by it already."""
        folder = self._folder("state", name)
        path = f"{self.store.path}/{folder}"
        out = rows if dealt else rows.repartition(max(len(buckets), 1), "bucket")
        out.write.partitionBy("bucket").parquet(path)
        entry = self.after["state"].setdefault(name, {"buckets": {}})["buckets"]
        for b in buckets:
            entry.pop(str(b), None)
        if not any(n.startswith("bucket=") for n in self.store._names(folder)):
            return
        written = self.store.spark.read.schema(rows.schema).parquet(path)
        for row in written.groupBy("bucket").agg(oldest.alias("oldest"), F.count(F.lit(1)).alias("rows")).collect():
            entry[str(row["bucket"])] = {"folder": f"{folder}/bucket={row['bucket']}",
                                         "oldest": row["oldest"], "rows": row["rows"]}

    def mark(self, name: str, value: int | None) -> int | None:
        """Raise a mark, such as a watermark, to ``value``; marks never fall."""
        marks = self.after["marks"]
        known = [x for x in (marks.get(name), value) if x is not None]
        marks[name] = max(known) if known else None
        return marks[name]

    def commit(self) -> None:
        if not self.store._commit(self.after):
            raise RuntimeError(f"another writer has made commit {self.number} of {self.store.path}")
