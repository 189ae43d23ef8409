"""Warehouse state on Parquet: materialize, publish a run, read, reset (SNK-1..4).

No transactional table format is assumed. A run writes every table it
changes to ``<root>/<table>/run=<run_id>/attempt=<unique>/`` (never to a
folder that exists) and then, last, a new pointer
file ``<root>/_pointers/<sequence>.json`` naming the paths of every table.
Pointer files are never overwritten (created exclusively, so a second
writer of the same sequence fails) and readers take the highest
sequence: a run becomes visible all at once or not at all, and a failed
run leaves the previous state untouched.

A pointer also keeps the state that its run started from. Running the
last published run id again starts from there and replaces what that run
had published: the same date twice gives the same state as once.

The table ``loaded_files`` is the ledger of the files whose rows are in the facts. It is
published with them, so whether a file was loaded never depends on what a
stream's checkpoint, an inbox or an archive remembers.
"""

from __future__ import annotations

import itertools
import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.session import checkpoint_dir

POINTERS = "_pointers"
#: Facts are written in ranges of their business key, sorted, with a Bloom filter on it:
#: looking up a day's keys reads the row groups that can hold them, not the whole key column.
KEY_RANGES = {"fact_transactions": "trans_id", "fact_blacklist": "passport_num"}


def materializer(spark: SparkSession, fallback_dir: str | None = None):
    """``df -> df`` that cuts lineage by writing a Parquet table and reading it back.

    The folder is the session's ``spark.checkpoint.dir`` (shared storage
    on a cluster); only where it is unset is ``fallback_dir`` installed.
    A written table survives lost executors like a reliable checkpoint,
    and reads back as a plain relation: Spark 4.1 keeps the origin plan's
    constraints on a checkpointed ``LogicalRDD`` and can then fail to
    optimize a union over it.
    """
    base = checkpoint_dir(spark, fallback_dir).rstrip("/") + f"/cardwatch-{uuid.uuid4().hex}"
    counter = itertools.count()

    def materialize(df: DataFrame) -> DataFrame:
        path = f"{base}/t{next(counter):04d}"
        write_parquet(df, path)
        return spark.read.schema(df.schema).parquet(path)
    return materialize


def write_parquet(df: DataFrame, path: str, mode: str = "errorifexists", options: dict | None = None) -> None:
    """Every write goes to a fresh folder, with the default (task-atomic) committer."""
    df.write.mode(mode).options(**(options or {})).parquet(path)


def _jvm_fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf), p


def _write_text(spark: SparkSession, path: str, text: str) -> None:
    """Small control file, created exclusively through Hadoop FS (any shared store)."""
    fs, p = _jvm_fs(spark, path)
    out = fs.create(p, False)
    out.write(bytearray(text.encode("utf-8")))
    out.close()


def _read_text(spark: SparkSession, path: str) -> str | None:
    fs, p = _jvm_fs(spark, path)
    if not fs.exists(p):
        return None
    jvm = spark.sparkContext._jvm
    stream = fs.open(p)
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
    lines = []
    line = reader.readLine()
    while line is not None:
        lines.append(line)
        line = reader.readLine()
    reader.close()
    return "\n".join(lines)


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _jvm_fs(spark, path)
    fs.delete(p, True)


def current(spark: SparkSession, root: str) -> dict:
    """The published state: {"seq", "run_id", "tables": {name: [paths]}}; empty before any run."""
    fs, p = _jvm_fs(spark, f"{root}/{POINTERS}")
    names = sorted(st.getPath().getName() for st in fs.listStatus(p)
                   if st.getPath().getName().endswith(".json")) if fs.exists(p) else []
    if not names:
        return {"seq": 0, "run_id": None, "tables": {}, "base": {}, "runs": []}
    return json.loads(_read_text(spark, f"{root}/{POINTERS}/{names[-1]}"))


def _read_paths(spark: SparkSession, name: str, paths: list[str]) -> DataFrame:
    schema = S.WAREHOUSE_TABLES[name]
    if not paths:
        return S.empty(spark, schema)
    return spark.read.schema(schema).parquet(*paths)


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A warehouse table as of the last published run (empty, with schema, if never written)."""
    return _read_paths(spark, name, current(spark, root)["tables"].get(name, []))


class Run:
    """One run's writes (SNK-1..3). Nothing is visible to readers before :meth:`commit`.

    * ``replace``: a new snapshot of the table (dimensions, watermark);
    * ``append``: only the new rows are written, as one more part of the
      table (insert-only facts, the report), so a large fact table is
      never rewritten.

    Both return the table as written (read back), so later steps of the
    run read the stored result instead of recomputing its plan.
    """

    def __init__(self, spark: SparkSession, root: str, run_id: str, profile: str | None = None):
        self.spark, self.root, self.run_id = spark, root.rstrip("/"), run_id
        self.attempt = uuid.uuid4().hex
        self.before = current(spark, self.root)
        # versions of the two profiles end differently: they cannot share one history
        known = self.before.get("profile")
        if profile and known and profile != known:
            raise ValueError(f"{self.root} holds versions of the {known} profile; a {profile} run needs a root of its own")
        self.profile = profile or known
        if self.before["run_id"] == run_id:       # a rerun replaces what the run published
            self.base = self.before["base"]
        elif run_id in self.before["runs"]:
            raise ValueError(f"run {run_id} was published and later runs build on it; "
                             f"only the last one ({self.before['run_id']}) can be run again")
        else:
            self.base = self.before["tables"]
        self.paths = {k: list(v) for k, v in self.base.items()}

    def _write(self, name: str, df: DataFrame) -> str:
        path = f"{self.root}/{name}/run={self.run_id}/attempt={self.attempt}"
        df, options, key = S.conform(df, S.WAREHOUSE_TABLES[name]), {}, KEY_RANGES.get(name)
        if key:
            df = df.repartitionByRange(F.col(key)).sortWithinPartitions(key)
            options = {f"parquet.bloom.filter.enabled#{key}": "true"}
        write_parquet(df, path, options=options)
        return path

    def replace(self, name: str, df: DataFrame) -> DataFrame:
        self.paths[name] = [self._write(name, df)]
        return _read_paths(self.spark, name, self.paths[name])

    def append(self, name: str, new_rows: DataFrame) -> DataFrame:
        self.paths[name] = [*self.paths.get(name, []), self._write(name, new_rows)]
        return _read_paths(self.spark, name, self.paths[name])

    def table(self, name: str) -> DataFrame:
        return _read_paths(self.spark, name, self.paths.get(name, []))

    def appended(self, name: str) -> DataFrame:
        """Only the rows that this run has appended."""
        mine = [p for p in self.paths.get(name, []) if p.endswith(f"/attempt={self.attempt}")]
        return _read_paths(self.spark, name, mine)

    def holds(self, name: str) -> bool:
        """Whether the table was ever written (an empty table was)."""
        return bool(self.paths.get(name))

    def forget(self, *names: str) -> None:
        """The tables are as if never written (derived state that this run does not keep up)."""
        for name in names:
            self.paths.pop(name, None)

    def record_files(self, files: list[tuple[str, int, str]]) -> None:
        """Put (name, size, day) of files into the ledger; a few rows a day, one small table."""
        rows = self.spark.createDataFrame([(*f, self.run_id) for f in files], S.LOADED_FILES)
        self.replace("loaded_files", self.table("loaded_files").unionByName(rows).coalesce(1))

    def loaded_files(self) -> set[tuple[str, int]]:
        """(name, size) of every file in the ledger of the state that the run starts from."""
        return {(r["file_name"], r["file_size"]) for r in self.table("loaded_files").select("file_name", "file_size").collect()}

    def commit(self, forget_runs: bool = False) -> dict:
        if forget_runs:
            self.profile = None
        seq = int(self.before["seq"]) + 1
        runs = [] if forget_runs else [r for r in self.before["runs"] if r != self.run_id]
        state = {"seq": seq, "run_id": self.run_id, "previous": self.before["run_id"],
                 "tables": self.paths, "base": self.base, "runs": [*runs, self.run_id], "profile": self.profile}
        _write_text(self.spark, f"{self.root}/{POINTERS}/{seq:012d}.json",
                    json.dumps(state, sort_keys=True))
        return state


def remove_superseded(spark: SparkSession, root: str) -> list[str]:
    """Retention, called explicitly: delete attempts that neither the published
    state nor the state its run started from refers to (older snapshots, failed
    and replaced attempts). Not while a run is under way. Returns the folders."""
    def whole(path):
        fs, p = _jvm_fs(spark, path)
        return fs.makeQualified(p).toString()

    now, removed = current(spark, root), []
    used = {whole(p) for tables in (now["tables"], now["base"]) for ps in tables.values() for p in ps}
    for name in S.WAREHOUSE_TABLES:
        fs, p = _jvm_fs(spark, f"{root.rstrip('/')}/{name}")
        for run in (fs.listStatus(p) if fs.exists(p) else []):
            for attempt in fs.listStatus(run.getPath()):
                path = fs.makeQualified(attempt.getPath())
                if path.toString() not in used:
                    fs.delete(path, True)
                    removed.append(path.toString())
    return removed


def publish(spark: SparkSession, root: str, run_id: str, replace: dict[str, DataFrame] | None = None,
            append: dict[str, DataFrame] | None = None, forget_runs: bool = False) -> dict:
    """SNK-3: write every table of the run, then switch the pointer once."""
    run = Run(spark, root, run_id)
    for name, df in (replace or {}).items():
        run.replace(name, df)
    for name, df in (append or {}).items():
        run.append(name, df)
    return run.commit(forget_runs)


def reset(spark: SparkSession, root: str, run_id: str, keep=("meta", "loaded_files")) -> dict:
    """SNK-4: every table but ``keep`` becomes empty (with its schema), in one publish.

    As in the reference, the watermark table is kept, so the next run's
    capture still starts from the old high-water mark. The ledger of loaded files is kept
    too: a file is loaded once, and what was deleted does not come back; ``keep=("meta",)`` lets files in the inbox load again.
    """
    return publish(spark, root, run_id, replace={
        n: S.empty(spark, sc) for n, sc in S.WAREHOUSE_TABLES.items() if n not in keep}, forget_runs=True)
