"""Warehouse state as run-scoped parquet directories plus a commit log.

Layout under ``root`` (a folder every executor can reach)::

    tables/<table>/run_id=<run>/...     what run <run> wrote for <table>
    log/<version>.json                  one entry per commit, written last (``commit_log``)

A run writes each table once and commits by its log entry; a run that fails, or
that loses a race against another writer, has no entry and its directories are
never read.  The entry names the runs it supersedes: a rerun of a load date holds
everything the earlier run of that date held (its transaction files are a
superset), so reruns are idempotent and a second delivery adds to the first.
The entry also keeps the range of the run's operation times, so a reader that
needs recent operations only skips older runs without opening them.

Dimension history is stored in two parts, because closed versions never
change again (every statement of the load only touches open rows):

* ``_part=closed``: versions closed by that run, append-only;
* ``_part=open``: the complete set of open versions after that run.

The current history is the last run's open part plus every run's closed part,
and a run rewrites only the open part.  Rows read from closed parts carry
``_closed_before = true``; the operators pass unknown columns through, so the
writer can drop them again and Catalyst prunes those scans where an operator
only passes them through.

A ``late`` run brings files of a date older than the newest load.  Beside its own
rows it may *rebase* a table (``rebased``): what it wrote takes the place of all
earlier runs of that table before the newest date, and a second folder takes
the place of the newest date's run (``replaces``).  It also brings the reports of
the dates it alters (``reports``).  See ``plans.late``.

A *unit* is a folder that compaction wrote from several runs (``compaction``); a
reader that asks for all of a unit's runs opens the unit instead.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from dataclasses import asdict, dataclass, field, fields, replace

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwatch import schemas as S
from cardwatch.functions import minus_days, ts_lit
from cardwatch.operators.extract import seed_watermarks
from cardwatch.operators.scd2 import is_open
from cardwatch.sources.commit_log import CHECKPOINT_EVERY, CommitLog, ConcurrentCommit

DIMS = {
    "dim_accounts_hist": S.DIM_ACCOUNTS_HIST,
    "dim_cards_hist": S.DIM_CARDS_HIST,
    "dim_clients_hist": S.DIM_CLIENTS_HIST,
    "dim_terminals_hist": S.DIM_TERMINALS_HIST,
}
FACTS = {
    "fact_transactions": S.FACT_TRANSACTIONS,
    "fact_passport_blacklist": S.FACT_PASSPORT_BLACKLIST,
    "rep_fraud": S.REP_FRAUD,
}
PROVENANCE = "_closed_before"
#: In folders that hold rows of several load dates: the date that loaded the row.
LOADED = "_loaded"


def _with_field(schema: T.StructType, name: str, dtype: T.DataType) -> T.StructType:
    return T.StructType(list(schema.fields) + [T.StructField(name, dtype, True)])


def _text(d: _dt.datetime | None) -> str | None:
    return None if d is None else d.isoformat()


def _date(t: str | None) -> _dt.datetime | None:
    return None if t is None else _dt.datetime.fromisoformat(t)


@dataclass(frozen=True)
class Run:
    run_id: str
    load_dt: _dt.datetime
    tx_min: _dt.datetime | None = None
    tx_max: _dt.datetime | None = None
    kind: str = "full"
    supersedes: tuple[str, ...] = ()
    #: tables of which this run takes the place of all earlier ones before the newest date
    rebased: tuple[str, ...] = ()
    #: (run, folder): the folder that takes the place of that run's for the rebased tables
    replaces: tuple[tuple[str, str], ...] = ()
    #: load dates whose report this run wrote
    reports: tuple[_dt.datetime, ...] = ()
    #: feeds this run staged
    feeds: tuple[str, ...] = ("transactions", "terminals", "blacklist")
    #: version of the state the run read, and the version it was committed as
    read_version: int | None = field(default=None, compare=False)
    version: int | None = field(default=None, compare=False)

    def to_json(self) -> dict:
        out = asdict(self)
        out |= {k: _text(getattr(self, k)) for k in ("load_dt", "tx_min", "tx_max")}
        out |= {"reports": [_text(d) for d in self.reports]}
        return out

    @staticmethod
    def of_json(entry: dict) -> Run:
        known = {k: v for k, v in entry.items() if k in {f.name for f in fields(Run)}}
        known |= {k: _date(known.get(k)) for k in ("load_dt", "tx_min", "tx_max")}
        known |= {k: tuple(known.get(k) or ()) for k in ("supersedes", "rebased", "feeds")}
        known |= {"replaces": tuple(tuple(x) for x in known.get("replaces") or ()), "reports": tuple(_date(d) for d in known.get("reports") or ())}
        return Run(**known)


@dataclass(frozen=True)
class Unit:
    """A folder of the rows of several runs."""

    unit_id: str
    level: int
    members: tuple[str, ...]
    tx_min: _dt.datetime | None
    tx_max: _dt.datetime | None

    def to_json(self) -> dict:
        return asdict(self) | {"kind": "compact", "tx_min": _text(self.tx_min), "tx_max": _text(self.tx_max)}

    @staticmethod
    def of_json(entry: dict) -> Unit:
        return Unit(entry["unit_id"], entry["level"], tuple(entry["members"]), _date(entry["tx_min"]), _date(entry["tx_max"]))


@dataclass(frozen=True)
class State:
    """The log, folded: runs that no later one supersedes, and the units that hold some of them."""

    version: int = -1
    runs: tuple[Run, ...] = ()
    units: tuple[Unit, ...] = ()

    def after(self, version: int, entry: dict) -> State:
        if entry["kind"] == "compact":
            unit = Unit.of_json(entry)
            kept = tuple(u for u in self.units if not set(u.members) & set(unit.members))
            return State(version, self.runs, (*kept, unit))
        run = replace(Run.of_json(entry), version=version)
        gone = set(run.supersedes)
        return State(version, tuple(r for r in self.runs if r.run_id not in gone) + (run,), tuple(u for u in self.units if not set(u.members) & gone))

    def to_json(self) -> dict:
        return {"version": self.version, "runs": [r.to_json() for r in self.runs], "units": [u.to_json() for u in self.units]}

    @staticmethod
    def of_json(state: dict) -> State:
        return State(state["version"], tuple(Run.of_json(r) for r in state["runs"]), tuple(Unit.of_json(u) for u in state["units"]))


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log")
        self._state = State()

    # -- paths ------------------------------------------------------------------------
    def table_dir(self, table: str) -> str:
        return f"{self.root}/tables/{table}"

    def run_dir(self, table: str, run_id: str) -> str:
        return f"{self.table_dir(table)}/run_id={run_id}"

    @staticmethod
    def new_run_id(load_dt: _dt.datetime) -> str:
        return f"r{load_dt:%Y%m%d}-{_dt.datetime.now(_dt.timezone.utc):%Y%m%d%H%M%S%f}-{uuid.uuid4().hex[:6]}"

    # -- commits ----------------------------------------------------------------------
    def state(self) -> State:
        """The newest state: a checkpoint and the entries behind it; reads only."""
        base, entries = self.log.load()
        state = State.of_json(base["state"]) if base else State()
        for version, entry in entries:
            state = state.after(version, entry)
        self._state = state
        return state

    def effective(self, before: _dt.datetime | None = None) -> list[Run]:
        """Committed runs that no later run supersedes, by load date (then time), for dates before ``before``."""
        runs = [r for r in self.state().runs if before is None or r.load_dt < before]
        return sorted(runs, key=lambda r: r.run_id)

    committed = effective

    def read_version(self) -> int:
        """Version of the state last read."""
        return self._state.version

    def commit(self, run: Run, semantics: str) -> Run:
        """Make a run visible, or fail if another run was committed since the state it read."""
        entry = run.to_json() | {"semantics": semantics, "committed_at": _text(_dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None))}
        entry["reports"] = entry["reports"] or [_text(run.load_dt)]
        version = (self.state().version if run.read_version is None else run.read_version) + 1
        while not self.log.append(version, entry):
            if self.log.read(version)["kind"] != "compact":  # a compaction moves rows, it changes none
                raise ConcurrentCommit(f"version {version} was committed by another run while {run.run_id} was loading")
            version += 1
        self._checkpoint(version)
        return replace(run, version=version)

    def commit_unit(self, unit: Unit, read_version: int) -> bool:
        """Swap a unit in for its members; False, and nothing changes, if one of them is gone or held by another unit."""
        version = read_version + 1
        while not self.log.append(version, unit.to_json()):
            entry = self.log.read(version)
            if set(unit.members) & set(entry["members"] if entry["kind"] == "compact" else entry["supersedes"]):
                return False
            version += 1
        self._checkpoint(version)
        return True

    def _checkpoint(self, version: int) -> None:
        if version % CHECKPOINT_EVERY == CHECKPOINT_EVERY - 1:
            state = self.state()
            if state.version == version:
                self.log.checkpoint(version, state.to_json())

    # -- reads -------------------------------------------------------------------------
    @staticmethod
    def bears(run: Run, table: str) -> bool:
        """Whether a run wrote a folder of a table: late runs write dimensions and watermarks only where they rebase them."""
        return run.kind == "full" or table in run.rebased or not (table in DIMS or table == "meta_data")

    def _folders(self, table: str, runs: list[Run]) -> list[str]:
        """The fewest folders that hold these runs: units that lie wholly among them, and the others' own."""
        wanted = {r.run_id for r in runs}
        known = {r.run_id: r for r in self._state.runs}
        out = []
        for u in self._state.units:
            held = {m for m in u.members if m not in known or self.bears(known[m], table)}
            if held and held <= wanted:
                out.append(u.unit_id)
                wanted -= held
        return out + [r.run_id for r in runs if r.run_id in wanted]

    def _read(self, table: str, schema: T.StructType, folders: list[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        paths = [self.run_dir(table, r) for r in folders]
        return (
            self.spark.read.schema(schema).option("basePath", self.table_dir(table)).parquet(*paths)
        )

    @staticmethod
    def _parts(table: str, runs: list[Run]) -> list[tuple[Run, str | None]]:
        """The runs that hold a table's rows, by load date, each with the folder that takes its place (None: its own).

        A run that rebased the table stands for all runs committed before it,
        but for the one it replaces.
        """
        place = lambda r: float("inf") if r.version is None else r.version  # noqa: E731  (not committed yet: last)
        base = max((r for r in runs if table in r.rebased), key=place, default=None)
        if base is None:
            return [(r, None) for r in runs]
        instead = dict(base.replaces)
        return [
            (r, instead.get(r.run_id)) for r in runs if r is base or r.run_id in instead or place(r) > place(base)
        ]

    def _placed(self, table: str, parts: list[tuple[Run, str | None]]) -> list[str]:
        return [p for _, p in parts if p] + self._folders(table, [r for r, p in parts if p is None])

    def dim(self, table: str, runs: list[Run]) -> DataFrame:
        """Full history (with the provenance column) after ``runs``.

        Each part is filtered by what holds for it by construction (open part:
        open rows; closed parts: no open row).  Every operator filters on
        ``is_open`` before it touches rows, so Catalyst combines the filters,
        finds the contradiction in one branch of the union and drops that scan:
        an operator that only modifies open rows never reads the closed parts.
        """
        schema = DIMS[table]
        parts = [(r, p) for r, p in self._parts(table, runs) if self.bears(r, table)]
        if not parts:
            return self.spark.createDataFrame([], schema).withColumn(PROVENANCE, F.lit(False))
        stored = _with_field(_with_field(schema, "run_id", T.StringType()), "_part", T.StringType())
        cols = [f.name for f in schema.fields]
        last, instead = parts[-1]
        open_part = (
            self._read(table, stored, [instead or last.run_id]).filter(F.col("_part") == "open").filter(is_open())
            .select(*cols, F.lit(False).alias(PROVENANCE))
        )
        closed = (
            self._read(table, stored, self._placed(table, parts)).filter(F.col("_part") == "closed")
            .filter(~is_open()).select(*cols, F.lit(True).alias(PROVENANCE))
        )
        return open_part.unionByName(closed)

    def fact(self, table: str, runs: list[Run], trans_after: _dt.datetime | None = None) -> DataFrame:
        """Rows a list of runs appended.  With ``trans_after`` (transactions
        only) runs whose operations all lie at or before it are not opened at
        all; the caller still filters rows exactly."""
        return self.fact_with_dates(table, runs, trans_after).drop(LOADED)

    def fact_with_dates(self, table: str, runs: list[Run], trans_after: _dt.datetime | None = None) -> DataFrame:
        """The same with column ``_loaded``: the load date that brought the row."""
        if trans_after is not None and table == "fact_transactions":
            units = {m: u for u in self._state.units for m in u.members}
            upper = lambda r: units[r.run_id].tx_max if r.run_id in units else r.tx_max
            runs = [r for r in runs if upper(r) is None or upper(r) > trans_after]
        stored = _with_field(_with_field(FACTS[table], LOADED, T.TimestampNTZType()), "run_id", T.StringType())
        return self._read(table, stored, self._placed(table, self._parts(table, runs))).withColumn(LOADED, F.coalesce(LOADED, _date_of_folder())).drop("run_id")

    def reports(self, runs: list[Run]) -> DataFrame:
        """The report of every load date: that of the run that wrote it last."""
        owner = {d: r for r in sorted(self._state.runs, key=lambda r: r.version) for d in r.reports}
        dates = {r.load_dt for r in runs}
        return self._reports({d: r for d, r in owner.items() if d in dates})

    def reports_of(self, runs: list[Run]) -> DataFrame:
        """The reports that these runs wrote and no later run wrote again."""
        owner = {d: r for r in sorted(self._state.runs, key=lambda r: r.version) for d in r.reports}
        ids = {r.run_id for r in runs}
        return self._reports({d: r for d, r in owner.items() if r.run_id in ids})

    def _reports(self, owner: dict[_dt.datetime, Run]) -> DataFrame:
        units = {m: u.unit_id for u in self._state.units for m in u.members}
        by_folder: dict[str, list[_dt.datetime]] = {}
        for d, r in owner.items():
            by_folder.setdefault(units.get(r.run_id, r.run_id), []).append(d)
        if not by_folder:
            return self.spark.createDataFrame([], FACTS["rep_fraud"])
        stored = _with_field(FACTS["rep_fraud"], "run_id", T.StringType())
        rows = self._read("rep_fraud", stored, sorted(by_folder))
        # a folder may also hold reports that were written again since
        own = [(k, _text(d)) for k, ds in by_folder.items() for d in ds]
        owned = F.broadcast(self.spark.createDataFrame(own, "run_id string, d string"))  # one row per load date
        day = F.date_format(minus_days("report_dt", 1), "yyyy-MM-dd'T'HH:mm:ss")
        return rows.withColumn("d", day).join(owned, ["run_id", "d"], "left_semi").drop("run_id", "d")

    def staged(self, table: str, schema: T.StructType, runs: list[Run]) -> DataFrame:
        """What runs staged from their feeds."""
        stored = _with_field(schema, "run_id", T.StringType())
        return self._read(table, stored, [r.run_id for r in runs]).drop("run_id")

    def staged_with_dates(self, table: str, schema: T.StructType, runs: list[Run]) -> DataFrame:
        stored = _with_field(schema, "run_id", T.StringType())
        return self._read(table, stored, [r.run_id for r in runs]).withColumn(LOADED, _date_of_folder()).drop("run_id")

    def rejects(self, runs: list[Run]) -> DataFrame:
        """Feed lines that runs left out."""
        return self.staged("rejects", S.REJECTS, [r for r in runs if "rejects" in r.feeds])

    def meta(self, runs: list[Run]) -> DataFrame:
        parts = [(r, p) for r, p in self._parts("meta_data", runs) if self.bears(r, "meta_data")]
        if not parts:
            return seed_watermarks(self.spark)
        stored = _with_field(S.META_DATA, "run_id", T.StringType())
        last, instead = parts[-1]
        return self._read("meta_data", stored, [instead or last.run_id]).drop("run_id")

    def ledger(self, runs: list[Run]) -> DataFrame:
        """Feed files consumed by ``runs`` (one row per file)."""
        from cardwatch.sources.feeds import LEDGER

        if not runs:
            return self.spark.createDataFrame([], LEDGER)
        folders = self._folders("ledger", runs)
        return self.spark.read.schema(LEDGER).parquet(*[self.run_dir("ledger", r) for r in folders])

    # -- writes ------------------------------------------------------------------------
    def write(self, table: str, run: Run | str, df: DataFrame) -> DataFrame:
        """Write and read back: later steps read the written files, which cuts
        the lineage (a lost executor recomputes from files, not the plan)."""
        path = self.run_dir(table, run if isinstance(run, str) else run.run_id)
        df.write.mode("overwrite").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def write_observed(self, table: str, run: Run | str, df: DataFrame, **times: Column) -> tuple[DataFrame, dict[str, _dt.datetime | None]]:
        """As :meth:`write`, with the values of these aggregates over the written rows, taken by the same pass.

        Only for minima and maxima of timestamps: a task that runs twice may be
        observed twice, which changes neither.
        """
        seen = Observation()
        text = {k: c.cast("string").alias(k) for k, c in times.items()}  # zone-free
        out = self.write(table, run, df.observe(seen, *text.values()))
        values = seen.get
        return out, {k: _date(values.get(k)) for k in times}

    @staticmethod
    def dim_output(table: str, hist: DataFrame) -> DataFrame:
        """What a run writes for a dimension: the open set and the versions
        closed by this run; rows read from closed parts are dropped, which
        lets Catalyst skip reading them wherever they were only passed along."""
        schema = DIMS[table]
        fresh = hist.filter(~F.coalesce(F.col(PROVENANCE), F.lit(False))) if PROVENANCE in hist.columns else hist
        return fresh.select(
            *[F.col(f.name).cast(f.dataType) for f in schema.fields],
            F.when(is_open(), F.lit("open")).otherwise(F.lit("closed")).alias("_part"),
        )

    def write_dim(self, table: str, run: Run | str, hist: DataFrame) -> None:
        """Write the open set and the newly closed versions of a history frame."""
        out = self.dim_output(table, hist)
        out.write.mode("overwrite").partitionBy("_part").parquet(self.run_dir(table, run if isinstance(run, str) else run.run_id))


def _date_of_folder() -> Column:
    """Load date in the name of a run's folder (``r20240301-...``)."""
    return F.to_timestamp_ntz(F.substring("run_id", 2, 8), F.lit("yyyyMMdd"))


def loaded_until(df: DataFrame, load_dt: _dt.datetime) -> DataFrame:
    return df.filter(F.col(LOADED) <= ts_lit(load_dt))
