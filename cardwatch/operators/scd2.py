"""Type-2 slowly changing dimensions as snapshot -> snapshot functions.

Parquet has no MERGE/UPDATE, so each statement of the source's load becomes a
pure function from the old history frame to the new one.  Two facts keep the
work proportional to what can change rather than to the whole history:

* only *open* rows (``effective_to = 5999-12-31``) are ever modified, so each
  function splits the history into open and other rows and joins only the
  open part; the rest is passed through untouched (no shuffle);
* extra columns of ``hist`` (e.g. the store's provenance column) are carried
  through, and rows a function creates get NULL there.

Every join is an equi-join on the dimension key; the delta, key and file sides
are aggregated per key first where the source demands at most one match.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwatch import schemas as S
from cardwatch.functions import differs_null_safe, minus_days, plus_days, ts_lit
from cardwatch.operators.extract import change_ts


@dataclass(frozen=True)
class DimSpec:
    key: str                         # key column in the history
    source_key: str                  # key column in the source / delta / file
    attrs: tuple[str, ...]           # history attribute columns, in table order
    source_attrs: tuple[str, ...]    # the matching source columns
    compared: tuple[str, ...] = ()   # columns the snapshot load compares (literal form)


ACCOUNTS = DimSpec("account_num", "account", ("valid_to", "client"), ("valid_to", "client"))
CARDS = DimSpec("card_num", "card_num", ("account_num",), ("account",))
_CLIENT_ATTRS = ("last_name", "first_name", "patronymic", "date_of_birth", "passport_num", "passport_valid_to", "phone")
CLIENTS = DimSpec("client_id", "client_id", _CLIENT_ATTRS, _CLIENT_ATTRS)
TERMINALS = DimSpec(
    "terminal_id", "terminal_id",
    ("terminal_type", "terminal_city", "terminal_address"),
    ("terminal_type", "terminal_city", "terminal_address"),
    compared=("terminal_city", "terminal_address"),
)


def is_open() -> Column:
    """Null-safe, so that ``is_open`` and its negation partition the rows."""
    return F.col("effective_to").eqNullSafe(ts_lit(S.OPEN_END))


def is_live_open() -> Column:
    return is_open() & F.col("deleted_flg").eqNullSafe(F.lit(S.FLAG_LIVE))


def _split(hist: DataFrame, cond: Column) -> tuple[DataFrame, DataFrame]:
    return hist.filter(cond), hist.filter(~cond)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def _with(df: DataFrame, columns: list[str], **replace: Column) -> DataFrame:
    return df.select(*[replace[c].alias(c) if c in replace else F.col(c) for c in columns])


def _new_versions(rows: DataFrame, spec: DimSpec, key: str, attrs: tuple[str, ...],
                  effective_from: Column, flag: str = S.FLAG_LIVE) -> DataFrame:
    return rows.select(
        F.col(key).alias(spec.key),
        *[F.col(s).alias(h) for h, s in zip(spec.attrs, attrs)],
        effective_from.alias("effective_from"),
        ts_lit(S.OPEN_END).alias("effective_to"),
        F.lit(flag).alias("deleted_flg"),
    )


def _one_match(what: str) -> Column:
    return F.raise_error(F.lit(f"MERGE: a history row matches more than one {what} row"))


# --- C3 ------------------------------------------------------------------------------

def scd2_insert(hist: DataFrame, delta: DataFrame, spec: DimSpec) -> DataFrame:
    """New and changed source rows become open live versions.

    A new row (``update_dt`` NULL) starts at ``create_dt``, a changed one at
    ``update_dt``: together ``coalesce(update_dt, create_dt)``.
    """
    new = _new_versions(delta, spec, spec.source_key, spec.source_attrs, change_ts())
    return hist.unionByName(new, allowMissingColumns=True)


# --- C4 ------------------------------------------------------------------------------

def scd2_close(hist: DataFrame, delta: DataFrame, spec: DimSpec) -> DataFrame:
    """Close the open versions a changed row replaces (MERGE, update only).

    A history row matches a delta row of its key when
    ``effective_from < coalesce(update_dt, 1899-01-01)``; a matched open row
    ends one day before ``update_dt`` (time of day kept).  The version inserted
    from the same delta starts *at* ``update_dt`` and so is never matched.
    More than one delta row per key would make the MERGE ambiguous: it raises.
    """
    d = delta.groupBy(F.col(spec.source_key).alias(spec.key)).agg(
        F.count(F.lit(1)).alias("_n"), F.max("update_dt").alias("_u")
    )
    open_rows, rest = _split(hist, is_open())
    j = open_rows.join(d, spec.key, "left")
    matched = F.col("_n").isNotNull() & (F.col("effective_from") < F.coalesce(F.col("_u"), ts_lit(S.BEGINNING)))
    new_to = (
        F.when(matched & (F.col("_n") > 1), _one_match("delta"))
        .when(matched, minus_days("_u", 1))
        .otherwise(F.col("effective_to"))
    )
    return rest.unionByName(_with(j, hist.columns, effective_to=new_to))


# --- C5 / C5c --------------------------------------------------------------------------

def scd2_delete(hist: DataFrame, keys: DataFrame, load_dt: _dt.datetime, spec: DimSpec,
                corrected: bool = False) -> DataFrame:
    """Soft delete of keys gone from the source.

    For every open live row whose key is not in ``keys``: insert a tombstone
    ('Y', from the load date, open), and close the live row.  The source closes
    it at load date + 1 day, overlapping the tombstone by two days;
    ``corrected=True`` closes it at load date - 1 day instead.
    A NULL key is never "in" the closing UPDATE's key list, so such a row gets a
    tombstone but stays open, as in the source.
    """
    # distinct: copies of a key collapse map-side, in the shuffle the joins need anyway
    k = keys.select(F.col(keys.columns[0]).alias(spec.key)).distinct()
    cand, rest = _split(hist, is_live_open())
    victims = cand.join(k, spec.key, "left_anti")
    stay = cand.join(k, spec.key, "left_semi")
    close_at = minus_days(ts_lit(load_dt), 1) if corrected else plus_days(ts_lit(load_dt), 1)
    closed = _with(
        victims, hist.columns,
        effective_to=F.when(F.col(spec.key).isNull(), F.col("effective_to")).otherwise(close_at),
    )
    tomb = victims.select(
        *[F.col(c) for c in [spec.key, *spec.attrs]],
        ts_lit(load_dt).alias("effective_from"),
        ts_lit(S.OPEN_END).alias("effective_to"),
        F.lit(S.FLAG_DELETED).alias("deleted_flg"),
    )
    return _union([rest, stay, closed, tomb])


def scd2_delete_corrected(hist: DataFrame, keys: DataFrame, load_dt: _dt.datetime, spec: DimSpec) -> DataFrame:
    return scd2_delete(hist, keys, load_dt, spec, corrected=True)


# --- C3 + C4 + C5 ------------------------------------------------------------------------

def scd2_load(hist: DataFrame, delta: DataFrame, keys: DataFrame, load_dt: _dt.datetime, spec: DimSpec,
              corrected: bool = False) -> DataFrame:
    """One dimension's daily load: the source's insert, close and delete in one keyed pass.

    Keys and delta become one change row per key (listed, number of changes,
    latest change time); the open rows and the inserted versions are joined to
    it once, and each yields itself, closed or kept, and its tombstone if its
    key is gone.  Equal to :func:`scd2_insert`, :func:`scd2_close` (or
    :func:`scd2_close_corrected`) and :func:`scd2_delete` one after the other.
    """
    u = change_ts() if corrected else F.col("update_dt")
    none = F.lit(None).cast("timestamp_ntz")
    changes = (
        keys.select(F.col(keys.columns[0]).alias(spec.key), F.lit(1).alias("_p"), F.lit(0).alias("_n"), none.alias("_u"))
        .unionByName(delta.select(F.col(spec.source_key).alias(spec.key), F.lit(0).alias("_p"), F.lit(1).alias("_n"), u.alias("_u")))
        .groupBy(spec.key)
        .agg(F.max("_p").alias("_p"), F.sum("_n").alias("_n"), F.max("_u").alias("_u"))
    )
    open_rows, rest = _split(hist, is_open())
    new = _new_versions(delta, spec, spec.source_key, spec.source_attrs, change_ts())
    j = open_rows.unionByName(new, allowMissingColumns=True).join(changes, spec.key, "left")
    changed_at = F.col("_u") if corrected else F.coalesce(F.col("_u"), ts_lit(S.BEGINNING))
    matched = (F.col("_n") > 0) & (F.col("effective_from") < changed_at)
    j = j.withColumn(
        "_to",
        F.when(matched & (F.col("_n") > 1), _one_match("delta")).when(matched, minus_days("_u", 1)).otherwise(F.col("effective_to")),
    )
    gone = (
        F.col("_to").eqNullSafe(ts_lit(S.OPEN_END)) & F.col("deleted_flg").eqNullSafe(F.lit(S.FLAG_LIVE))
        & (F.coalesce(F.col("_p"), F.lit(0)) == 0)
    )
    close_at = minus_days(ts_lit(load_dt), 1) if corrected else plus_days(ts_lit(load_dt), 1)
    # a NULL key is never in the closing UPDATE's key list: it gets a tombstone but stays open
    own = {"effective_to": F.when(gone & F.col(spec.key).isNotNull(), close_at).otherwise(F.col("_to"))}
    kept = {c: F.col(c) for c in [spec.key, *spec.attrs]}
    tomb = kept | {"effective_from": ts_lit(load_dt), "effective_to": ts_lit(S.OPEN_END), "deleted_flg": F.lit(S.FLAG_DELETED)}
    types = {f.name: f.dataType for f in hist.schema.fields}
    row = F.struct(*[own.get(c, F.col(c)).alias(c) for c in hist.columns])
    tombstone = F.struct(*[tomb.get(c, F.lit(None)).cast(types[c]).alias(c) for c in hist.columns])
    rows = j.select(F.explode(F.when(gone, F.array(row, tombstone)).otherwise(F.array(row))).alias("_r")).select("_r.*")
    return rest.unionByName(rows)


def scd2_close_corrected(hist: DataFrame, delta: DataFrame, spec: DimSpec) -> DataFrame:
    """As :func:`scd2_close`, with the change time ``coalesce(update_dt, create_dt)``.

    A key that returns after a delete with a fresh ``create_dt`` (no
    ``update_dt``) then also closes its open tombstone, so at most one row per
    key stays open.
    """
    d = delta.groupBy(F.col(spec.source_key).alias(spec.key)).agg(
        F.count(F.lit(1)).alias("_n"), F.max(change_ts()).alias("_u")
    )
    open_rows, rest = _split(hist, is_open())
    j = open_rows.join(d, spec.key, "left")
    matched = F.col("_n").isNotNull() & (F.col("effective_from") < F.col("_u"))
    new_to = (
        F.when(matched & (F.col("_n") > 1), _one_match("delta"))
        .when(matched, minus_days("_u", 1))
        .otherwise(F.col("effective_to"))
    )
    return rest.unionByName(_with(j, hist.columns, effective_to=new_to))


# --- C6 ----------------------------------------------------------------------------------

def snapshot_scd2(hist: DataFrame, snapshot: DataFrame, load_dt: _dt.datetime,
                  spec: DimSpec = TERMINALS) -> DataFrame:
    """Full-snapshot load as the source writes it (terminals).

    1. ids never seen in the history: new versions from load date + 1;
    2. for every (file row, history row of the id) pair with
       ``a <> h.a OR b <> h.b AND h is open`` (AND binds tighter; any version,
       also closed ones, is compared): a new version from load date + 1;
    3. every open version with ``effective_from < load date + 1`` whose id is
       in the file is closed at the load date, changed or not.
    """
    dt_next = plus_days(ts_lit(load_dt), 1)
    a, b = spec.compared
    f = snapshot.select(F.col(spec.source_key).alias(spec.key),
                        *[F.col(s).alias(h) for h, s in zip(spec.attrs, spec.source_attrs)])

    new = f.join(hist.select(spec.key), spec.key, "left_anti")
    new = _new_versions(new, spec, spec.key, spec.attrs, dt_next)

    h = hist.select(spec.key, F.col(a).alias("_ha"), F.col(b).alias("_hb"), F.col("effective_to").alias("_hto"))
    pairs = f.join(h, spec.key, "inner").filter(
        (F.col(a) != F.col("_ha")) | ((F.col(b) != F.col("_hb")) & (F.col("_hto") == ts_lit(S.OPEN_END)))
    )
    changed = _new_versions(pairs, spec, spec.key, spec.attrs, dt_next)

    ids = f.groupBy(spec.key).agg(F.count(F.lit(1)).alias("_n"))
    open_rows, rest = _split(hist, is_open())
    j = open_rows.join(ids, spec.key, "left")
    matched = F.col("_n").isNotNull() & (F.col("effective_from") < dt_next)
    new_to = (
        F.when(matched & (F.col("_n") > 1), _one_match("file"))
        .when(matched, ts_lit(load_dt))
        .otherwise(F.col("effective_to"))
    )
    closed = _with(j, hist.columns, effective_to=new_to)
    return _union([rest, closed, new, changed])


# --- C7 ----------------------------------------------------------------------------------

def snapshot_scd2_corrected(hist: DataFrame, snapshot: DataFrame, load_dt: _dt.datetime,
                            spec: DimSpec = TERMINALS, tracked: tuple[str, ...] | None = None) -> DataFrame:
    """Full-snapshot load as intended.

    Compared against the *open live* version only, null-safely, on every
    tracked column (all attributes by default, so a type change counts):

    * a file row with no equal open live version gets a new version from the
      load date (new ids, changed ids and ids back after a delete);
    * an open live version that differs from its file row ends the day before;
    * an open tombstone of an id back in the file ends the day before.
    Ids missing from the file are left to :func:`scd2_delete`.
    """
    tracked = tuple(tracked or spec.attrs)
    dt = ts_lit(load_dt)
    before = minus_days(dt, 1)
    f = snapshot.select(F.col(spec.source_key).alias(spec.key),
                        *[F.col(s).alias(h) for h, s in zip(spec.attrs, spec.source_attrs)])
    ids = f.groupBy(spec.key).agg(F.count(F.lit(1)).alias("_n"))
    fcmp = f.join(ids, spec.key, "inner").select(
        spec.key, *[F.col(c).alias(f"_f_{c}") for c in tracked], F.lit(True).alias("_in_file"), "_n")
    dup = F.raise_error(F.lit("snapshot has a duplicate key"))

    live, rest = _split(hist, is_live_open())
    tombs, rest = _split(rest, is_open())

    differs = F.lit(False)
    for c in tracked:
        differs = differs | differs_null_safe(F.col(c), F.col(f"_f_{c}"))

    j = live.join(fcmp, spec.key, "left")
    live_new = _with(j, hist.columns, effective_to=(
        F.when(F.col("_n") > 1, dup).when(F.col("_in_file") & differs, before).otherwise(F.col("effective_to"))))

    same = live.select(spec.key, *tracked).join(fcmp, spec.key, "inner").filter(~differs).select(spec.key)
    ins = f.join(same, spec.key, "left_anti").join(ids, spec.key, "left")
    ins = ins.withColumn(spec.key, F.when(F.col("_n") > 1, dup).otherwise(F.col(spec.key)))
    inserted = _new_versions(ins, spec, spec.key, spec.attrs, dt)

    t = tombs.join(ids, spec.key, "left")
    tombs_new = _with(t, hist.columns, effective_to=(
        F.when(F.col("_n") > 1, dup).when(F.col("_n").isNotNull(), before).otherwise(F.col("effective_to"))))
    return _union([rest, live_new, tombs_new, inserted])
