"""The registered queries as plain SQL over the driver tables (DuckDB dialect).

Written the way the source writes its statements: self-joins for R3/R4,
``LEFT JOIN ... IS NULL`` anti joins, IN-subqueries, UPDATE-as-CASE.  The
views at the top are the same projections as ``sources.testdata``.
"""

from __future__ import annotations

OPEN = "TIMESTAMP '5999-12-31 00:00:00'"
BEGIN = "TIMESTAMP '1899-01-01 00:00:00'"
DT = "TIMESTAMP '2024-01-15 00:00:00'"
DT_NEXT = "TIMESTAMP '2024-01-16 00:00:00'"
DT_PREV = "TIMESTAMP '2024-01-14 00:00:00'"
CLIENTS_WM = "TIMESTAMP '2024-01-01 00:00:00'"
BLACKLIST_WM = "TIMESTAMP '2024-01-10 00:00:00'"
CITY_W = "INTERVAL 1 HOUR"
PROBE_W = "INTERVAL 1 DAY"

_CLIENT_ATTRS = "last_name, first_name, patronymic, date_of_birth, passport_num, passport_valid_to, phone"


def _days(expr: str) -> str:
    return f"to_days(CAST({expr} AS INTEGER))"


def _client_cols(updated: str | None = None) -> str:
    valid_to = f"CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE TIMESTAMP '2023-06-01' + {_days('(c_custkey * 53) % 800')} END"
    if updated:
        valid_to = f"CASE WHEN {updated} THEN ({valid_to}) + {_days('400')} ELSE ({valid_to}) END"
    return f"""CAST(c_custkey AS VARCHAR) AS client_id,
        c_mktsegment AS last_name,
        CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE c_name END AS first_name,
        CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE 'N' || CAST(c_nationkey AS VARCHAR) END AS patronymic,
        TIMESTAMP '1950-01-01' + {_days('(c_custkey * 37) % 18000')} AS date_of_birth,
        c_name AS passport_num,
        {valid_to} AS passport_valid_to,
        '+7' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') AS phone"""


_PADDED_CARD = "CAST(c_custkey AS VARCHAR) || CASE WHEN c_custkey % 2 = 1 THEN '  ' ELSE '' END"
_UPDATED = "(c_custkey % 10 <> 0 AND c_custkey % 7 = 0)"

# name -> (sql, dependencies)
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "tx": (f"""SELECT event_id AS trans_id, ts AS trans_date, CAST(user_id AS VARCHAR) AS card_num,
        event_type AS oper_type, CAST(value AS DECIMAL(10,2)) AS amt,
        CASE WHEN event_type = 'error' THEN 'REJECT' ELSE 'SUCCESS' END AS oper_result,
        CAST(event_id % (SELECT count(*) FROM supplier) AS VARCHAR) AS terminal
        FROM events""", ()),
    "stg_tx": ("""SELECT CAST(trans_id AS VARCHAR) AS transaction_id, trans_date AS transaction_date,
        amt AS amount, card_num, oper_type, oper_result, terminal FROM tx""", ("tx",)),
    "term": ("""SELECT CAST(s_suppkey AS VARCHAR) AS terminal_id,
        CASE WHEN s_suppkey % 3 = 0 THEN 'ATM' ELSE 'POS' END AS terminal_type,
        n_name AS terminal_city, s_name AS terminal_address
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""", ()),
    "term_dim": (f"""SELECT terminal_id, terminal_type, terminal_city, terminal_address,
        TIMESTAMP '2020-01-01' AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg FROM term""", ("term",)),
    "term_hist": (f"""SELECT terminal_id, terminal_type, terminal_city, terminal_address,
            TIMESTAMP '2024-01-01' AS effective_from, {OPEN} AS effective_to, 'N' AS deleted_flg
        FROM term WHERE CAST(terminal_id AS BIGINT) % 5 <> 0
        UNION ALL
        SELECT terminal_id, terminal_type, 'OLD_' || terminal_city, terminal_address,
            TIMESTAMP '2023-01-01', TIMESTAMP '2023-12-31', 'N'
        FROM term WHERE CAST(terminal_id AS BIGINT) % 5 <> 0 AND CAST(terminal_id AS BIGINT) % 4 = 0""", ("term",)),
    "term_file": ("""SELECT terminal_id, terminal_type,
        CASE WHEN CAST(terminal_id AS BIGINT) % 7 = 0 THEN 'NEW_' || terminal_city ELSE terminal_city END AS terminal_city,
        terminal_address FROM term WHERE CAST(terminal_id AS BIGINT) % 6 <> 0""", ("term",)),
    "cards": (f"""SELECT {_PADDED_CARD} AS card_num, CAST(c_custkey * 10 AS VARCHAR) AS account_num
        FROM customer""", ()),
    "cards_src": (f"""SELECT {_PADDED_CARD} AS card_num, CAST(c_custkey * 10 AS VARCHAR) AS account,
        TIMESTAMP '2020-01-01' + {_days('c_custkey % 1000')} AS create_dt,
        CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '2024-01-11 08:00:00' END AS update_dt
        FROM customer""", ()),
    "cards_hist": (f"""SELECT card_num, account_num, TIMESTAMP '2020-01-01' AS effective_from,
        {OPEN} AS effective_to, 'N' AS deleted_flg FROM cards""", ("cards",)),
    "acc": ("""SELECT CAST(o_orderkey AS VARCHAR) AS account_num, o_orderdate + INTERVAL 26 YEAR AS valid_to,
        CAST(o_custkey AS VARCHAR) AS client FROM orders""", ()),
    "acc_src": ("""SELECT CAST(o_orderkey AS VARCHAR) AS account, o_orderdate + INTERVAL 26 YEAR AS valid_to,
        CAST(o_custkey AS VARCHAR) AS client, o_orderdate AS create_dt,
        CASE WHEN o_orderkey % 9 = 0 THEN TIMESTAMP '2024-01-13 10:30:00' END AS update_dt
        FROM orders""", ()),
    "acc_hist": (f"""SELECT account_num, valid_to, client, TIMESTAMP '2020-01-01' AS effective_from,
        {OPEN} AS effective_to, 'N' AS deleted_flg FROM acc""", ("acc",)),
    "cl": (f"SELECT {_client_cols()} FROM customer", ()),
    "bl": (f"""SELECT TIMESTAMP '2024-01-01' + {_days('c_custkey % 30')} AS entry_dt, c_name AS passport_num
        FROM customer WHERE c_custkey % 17 = 0""", ()),
    "hist": (f"""SELECT {_client_cols()}, TIMESTAMP '2020-01-01' AS effective_from, {OPEN} AS effective_to,
        'N' AS deleted_flg FROM customer WHERE c_custkey % 10 <> 0""", ()),
    "src": ("SELECT * FROM src_all WHERE CAST(client_id AS BIGINT) % 13 <> 0", ("src_all",)),
    "src_all": (f"""SELECT {_client_cols(_UPDATED)},
        CASE WHEN c_custkey % 10 = 0 THEN TIMESTAMP '2024-01-10' ELSE TIMESTAMP '2020-01-01' END AS create_dt,
        CASE WHEN {_UPDATED} THEN TIMESTAMP '2024-01-12' END AS update_dt
        FROM customer""", ()),
    "tx_dense": ("""SELECT * REPLACE (TIMESTAMP '2024-01-01' + to_microseconds(
            (epoch_us(trans_date) - epoch_us(TIMESTAMP '2024-01-01')) // 72) AS trans_date) FROM tx""", ("tx",)),
    # --- derived -------------------------------------------------------------------
    "delta": (f"SELECT * FROM src WHERE COALESCE(update_dt, create_dt) > {CLIENTS_WM}", ("src",)),
    "keys": ("SELECT client_id FROM src", ("src",)),
    "chain": (f"""SELECT tx.*, c.card_num AS dim_card_num, c.account_num, a.valid_to,
            cl.client_id, cl.last_name, cl.first_name, cl.patronymic, cl.passport_num, cl.passport_valid_to, cl.phone
        FROM tx
        LEFT JOIN cards c ON tx.card_num = RTRIM(c.card_num)
        LEFT JOIN acc a ON c.account_num = a.account_num
        LEFT JOIN cl ON a.client = cl.client_id""", ("tx", "cards", "acc", "cl")),
    # SCD2 load of clients: insert (C3), close (C4), tombstone + close
    "h1": (f"""SELECT client_id, {_CLIENT_ATTRS}, effective_from, effective_to, deleted_flg FROM hist
        UNION ALL
        SELECT client_id, {_CLIENT_ATTRS}, COALESCE(update_dt, create_dt), {OPEN}, 'N' FROM delta""",
           ("hist", "delta")),
    "h2": (f"""SELECT h.client_id, {', '.join('h.' + c.strip() for c in _CLIENT_ATTRS.split(','))}, h.effective_from,
            CASE WHEN d.client_id IS NOT NULL AND h.effective_to = {OPEN}
                      AND h.effective_from < COALESCE(d.update_dt, {BEGIN})
                 THEN d.update_dt - INTERVAL 1 DAY ELSE h.effective_to END AS effective_to,
            h.deleted_flg
        FROM h1 h LEFT JOIN delta d ON h.client_id = d.client_id""", ("h1", "delta")),
    "h3": (f"""SELECT h.client_id, {', '.join('h.' + c.strip() for c in _CLIENT_ATTRS.split(','))}, h.effective_from,
            CASE WHEN h.effective_to = {OPEN} AND h.deleted_flg = 'N' AND k.client_id IS NULL
                 THEN {DT_NEXT} ELSE h.effective_to END AS effective_to,
            h.deleted_flg
        FROM h2 h LEFT JOIN (SELECT DISTINCT client_id FROM keys) k ON h.client_id = k.client_id
        UNION ALL
        SELECT h.client_id, {', '.join('h.' + c.strip() for c in _CLIENT_ATTRS.split(','))}, {DT}, {OPEN}, 'Y'
        FROM h2 h LEFT JOIN (SELECT DISTINCT client_id FROM keys) k ON h.client_id = k.client_id
        WHERE k.client_id IS NULL AND h.effective_to = {OPEN} AND h.deleted_flg = 'N'""", ("h2", "keys")),
    # corrected load: the change time closes every open row of the key (tombstones too),
    # deleted keys end the day before the load date
    "h2c": (f"""SELECT h.client_id, {', '.join('h.' + c.strip() for c in _CLIENT_ATTRS.split(','))}, h.effective_from,
            CASE WHEN d.client_id IS NOT NULL AND h.effective_to = {OPEN}
                      AND h.effective_from < COALESCE(d.update_dt, d.create_dt)
                 THEN COALESCE(d.update_dt, d.create_dt) - INTERVAL 1 DAY ELSE h.effective_to END AS effective_to,
            h.deleted_flg
        FROM h1 h LEFT JOIN delta d ON h.client_id = d.client_id""", ("h1", "delta")),
    "h3c": (f"""SELECT h.client_id, {', '.join('h.' + c.strip() for c in _CLIENT_ATTRS.split(','))}, h.effective_from,
            CASE WHEN h.effective_to = {OPEN} AND h.deleted_flg = 'N' AND k.client_id IS NULL
                 THEN {DT_PREV} ELSE h.effective_to END AS effective_to,
            h.deleted_flg
        FROM h2c h LEFT JOIN (SELECT DISTINCT client_id FROM keys) k ON h.client_id = k.client_id
        UNION ALL
        SELECT h.client_id, {', '.join('h.' + c.strip() for c in _CLIENT_ATTRS.split(','))}, {DT}, {OPEN}, 'Y'
        FROM h2c h LEFT JOIN (SELECT DISTINCT client_id FROM keys) k ON h.client_id = k.client_id
        WHERE k.client_id IS NULL AND h.effective_to = {OPEN} AND h.deleted_flg = 'N'""", ("h2c", "keys")),
    # rules over the whole fact
    "ops": ("""SELECT tx.trans_id, tx.card_num, tx.trans_date, t.terminal_city AS city
        FROM tx JOIN term_dim t ON tx.terminal = t.terminal_id""", ("tx", "term_dim")),
    "r3_pairs": (f"""SELECT a.trans_id AS a_id, a.trans_date AS a_dt, b.trans_id AS b_id
        FROM ops a JOIN ops b ON a.card_num = b.card_num AND a.trans_date < b.trans_date
        WHERE a.city <> b.city AND (b.trans_date - a.trans_date) < {CITY_W}""", ("ops",)),
    "r4_triples": (f"""SELECT a.trans_date AS a_dt, c.trans_id AS c_id
        FROM tx a JOIN tx b ON a.card_num = b.card_num AND a.trans_date < b.trans_date
        JOIN tx c ON b.card_num = c.card_num AND b.trans_date < c.trans_date
        WHERE a.oper_result = 'REJECT' AND b.oper_result = 'REJECT' AND c.oper_result = 'SUCCESS'
          AND a.amt > b.amt AND b.amt > c.amt AND (c.trans_date - a.trans_date) < {PROBE_W}""", ("tx",)),
}


def with_views(body: str, *needed: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for dep in VIEWS[n][1]:
            visit(dep)
        order.append(n)

    for n in needed:
        visit(n)
    ctes = ",\n".join(f"{n} AS (\n{VIEWS[n][0]}\n)" for n in order)
    return f"WITH {ctes}\n{body}"


_HIST_COLS = f"client_id, {_CLIENT_ATTRS}, effective_from, effective_to, deleted_flg"
_TERM_ATTRS = "terminal_type, terminal_city, terminal_address"

_SCD2_DELETE = """SELECT h.client_id, {attrs}, h.effective_from,
        CASE WHEN h.effective_to = {open} AND h.deleted_flg = 'N' AND k.client_id IS NULL
             THEN {close} ELSE h.effective_to END AS effective_to, h.deleted_flg
    FROM hist h LEFT JOIN (SELECT DISTINCT client_id FROM keys) k ON h.client_id = k.client_id
    UNION ALL
    SELECT h.client_id, {attrs}, {dt}, {open}, 'Y'
    FROM hist h LEFT JOIN (SELECT DISTINCT client_id FROM keys) k ON h.client_id = k.client_id
    WHERE k.client_id IS NULL AND h.effective_to = {open} AND h.deleted_flg = 'N'"""


def _scd2_delete(close: str) -> str:
    attrs = ", ".join("h." + c.strip() for c in _CLIENT_ATTRS.split(","))
    return with_views(_SCD2_DELETE.format(attrs=attrs, open=OPEN, close=close, dt=DT), "hist", "keys")


_SNAPSHOT_LITERAL = f"""SELECT h.terminal_id, h.terminal_type, h.terminal_city, h.terminal_address, h.effective_from,
        CASE WHEN h.effective_to = {OPEN} AND h.effective_from < {DT_NEXT}
                  AND h.terminal_id IN (SELECT terminal_id FROM term_file)
             THEN {DT} ELSE h.effective_to END AS effective_to, h.deleted_flg
    FROM term_hist h
    UNION ALL
    SELECT f.terminal_id, f.terminal_type, f.terminal_city, f.terminal_address, {DT_NEXT}, {OPEN}, 'N'
    FROM term_file f LEFT JOIN term_hist h ON f.terminal_id = h.terminal_id
    WHERE h.terminal_id IS NULL
    UNION ALL
    SELECT f.terminal_id, f.terminal_type, f.terminal_city, f.terminal_address, {DT_NEXT}, {OPEN}, 'N'
    FROM term_file f LEFT JOIN term_hist h ON f.terminal_id = h.terminal_id
    WHERE f.terminal_city <> h.terminal_city
       OR f.terminal_address <> h.terminal_address AND h.effective_to = {OPEN}"""

_SAME = " AND ".join(f"l.{c} IS NOT DISTINCT FROM f.{c}" for c in _TERM_ATTRS.split(", "))
_SNAPSHOT_CORRECTED = f"""SELECT h.terminal_id, h.terminal_type, h.terminal_city, h.terminal_address, h.effective_from,
        CASE
          WHEN h.effective_to = {OPEN} AND h.deleted_flg = 'N' AND f.terminal_id IS NOT NULL
               AND NOT ({_SAME.replace('l.', 'h.')}) THEN {DT_PREV}
          WHEN h.effective_to = {OPEN} AND h.deleted_flg IS DISTINCT FROM 'N' AND f.terminal_id IS NOT NULL
               THEN {DT_PREV}
          ELSE h.effective_to END AS effective_to,
        h.deleted_flg
    FROM term_hist h LEFT JOIN term_file f ON h.terminal_id = f.terminal_id
    UNION ALL
    SELECT f.terminal_id, f.terminal_type, f.terminal_city, f.terminal_address, {DT}, {OPEN}, 'N'
    FROM term_file f
    WHERE NOT EXISTS (SELECT 1 FROM term_hist l WHERE l.terminal_id = f.terminal_id
                      AND l.effective_to = {OPEN} AND l.deleted_flg = 'N' AND {_SAME})"""

_META = f"""meta AS (
    SELECT {BEGIN} AS last_update_dt, 'dwh' AS dbname, t AS table_name
    FROM (VALUES ('dim_accounts_hist'), ('dim_cards_hist'), ('dim_clients_hist'), ('dim_terminals_hist'),
                 ('fact_transactions'), ('fact_passport_blacklist')) v(t)),
upd AS (
    SELECT 'dim_accounts_hist' AS table_name, (SELECT max(COALESCE(update_dt, create_dt)) FROM acc_src
        WHERE COALESCE(update_dt, create_dt) > {BEGIN}) AS new_dt, true AS guarded
    UNION ALL SELECT 'dim_cards_hist', (SELECT max(COALESCE(update_dt, create_dt)) FROM cards_src
        WHERE COALESCE(update_dt, create_dt) > {BEGIN}), true
    UNION ALL SELECT 'dim_clients_hist', (SELECT max(COALESCE(update_dt, create_dt)) FROM src_all
        WHERE COALESCE(update_dt, create_dt) > {BEGIN}), true
    UNION ALL SELECT 'dim_terminals_hist', {DT_NEXT}, true
    UNION ALL SELECT 'fact_passport_blacklist', (SELECT max(entry_dt) FROM bl WHERE entry_dt > {BEGIN}), false
    UNION ALL SELECT 'fact_transactions', (SELECT max(transaction_date) FROM stg_tx), false),
advanced AS (
    SELECT CASE WHEN u.guarded IS NULL THEN m.last_update_dt
                WHEN u.guarded AND u.new_dt IS NULL THEN m.last_update_dt
                ELSE u.new_dt END AS last_update_dt, m.dbname, m.table_name
    FROM meta m LEFT JOIN upd u ON m.table_name = u.table_name)"""


def _with_meta(body: str) -> str:
    base = with_views("SELECT 1", "acc_src", "cards_src", "src_all", "bl", "stg_tx")
    return base.replace("\nSELECT 1", f",\n{_META}\n{body}")


_R1 = f"""(passport_valid_to IS NOT NULL AND passport_num IN (SELECT passport_num FROM bl))
          OR passport_valid_to < {DT}"""
_R3_LITERAL = "trans_date IN (SELECT max(a_dt) FROM r3_pairs)"
_R4_LITERAL = "trans_date IN (SELECT max(a_dt) FROM r4_triples)"
_R3_CARD = "trans_id IN (SELECT b_id FROM r3_pairs)"
_R4_CARD = "trans_id IN (SELECT c_id FROM r4_triples)"


def _case(r1: str, r2: str, r3: str, r4: str) -> str:
    return f"""CASE WHEN {r1} THEN 'PASSPORT_INVALID'
            WHEN {r2} THEN 'CONTRACT_EXPIRED'
            WHEN {r3} THEN 'CITY_VELOCITY'
            WHEN {r4} THEN 'AMOUNT_PROBING'
            ELSE 'OK' END"""


def _classified(r3: str, r4: str) -> str:
    return f"""SELECT trans_id, trans_date, passport_num, last_name, first_name, patronymic, phone,
        {_case(_R1, f'valid_to < {DT}', r3, r4)} AS event_type
    FROM chain WHERE trans_date > {DT}"""


_FIO = "COALESCE(last_name, '') || ' ' || COALESCE(first_name, '') || ' ' || COALESCE(patronymic, '')"


def _report(inner: str) -> str:
    return f"""SELECT trans_date AS event_dt, passport_num AS passport, {_FIO} AS fio, phone, event_type,
        {DT_NEXT} AS report_dt
    FROM ({inner}) x WHERE event_type <> 'OK'"""


_ASOF = f"""SELECT tx.*, c.account_num, a.valid_to, l.client_id, l.last_name, l.first_name, l.patronymic,
        l.passport_num, l.passport_valid_to, l.phone, l.effective_from AS client_effective_from
    FROM tx
    LEFT JOIN cards_hist c ON tx.card_num = RTRIM(c.card_num) AND tx.trans_date >= c.effective_from
        AND tx.trans_date < c.effective_to + INTERVAL 1 DAY AND c.deleted_flg = 'N'
    LEFT JOIN acc_hist a ON c.account_num = a.account_num AND tx.trans_date >= a.effective_from
        AND tx.trans_date < a.effective_to + INTERVAL 1 DAY AND a.deleted_flg = 'N'
    LEFT JOIN h3 l ON a.client = l.client_id AND tx.trans_date >= l.effective_from
        AND tx.trans_date < l.effective_to + INTERVAL 1 DAY AND l.deleted_flg = 'N'"""

_R1_CORRECTED = """(EXISTS (SELECT 1 FROM bl WHERE bl.passport_num = j.passport_num AND bl.entry_dt <= j.trans_date)
          OR j.passport_valid_to < j.trans_date)"""

_TRIPLES_20 = VIEWS["r4_triples"][0].replace("FROM tx a", "FROM tx_dense a").replace("JOIN tx ", "JOIN tx_dense ").replace(
    PROBE_W, "INTERVAL 20 MINUTE")


def _scd2_full(hist: str, src: str, key: str, source_key: str, attrs: dict[str, str]) -> str:
    """Insert, close, tombstone of a dimension whose every 13th key was deleted from the source."""
    names = ", ".join(attrs)
    own = ", ".join(f"h.{a}" for a in attrs)
    gone = f"k.key IS NULL AND h.effective_to = {OPEN} AND h.deleted_flg = 'N'"
    return with_views("SELECT 1", hist, src).replace("\nSELECT 1", f""",
kept AS (SELECT * FROM {src} WHERE CAST(RTRIM({source_key}) AS BIGINT) % 13 <> 0),
chg AS (SELECT * FROM kept WHERE COALESCE(update_dt, create_dt) > {CLIENTS_WM}),
d1 AS (SELECT {key}, {names}, effective_from, effective_to, deleted_flg FROM {hist}
    UNION ALL SELECT {source_key}, {', '.join(attrs.values())}, COALESCE(update_dt, create_dt), {OPEN}, 'N' FROM chg),
d2 AS (SELECT h.{key}, {own}, h.effective_from,
        CASE WHEN d.{source_key} IS NOT NULL AND h.effective_to = {OPEN} AND h.effective_from < COALESCE(d.update_dt, {BEGIN})
             THEN d.update_dt - INTERVAL 1 DAY ELSE h.effective_to END AS effective_to, h.deleted_flg
    FROM d1 h LEFT JOIN chg d ON h.{key} = d.{source_key}),
k AS (SELECT DISTINCT {source_key} AS key FROM kept)
SELECT h.{key}, {own}, h.effective_from, CASE WHEN {gone} THEN {DT_NEXT} ELSE h.effective_to END AS effective_to, h.deleted_flg
FROM d2 h LEFT JOIN k ON h.{key} = k.key
UNION ALL SELECT h.{key}, {own}, {DT}, {OPEN}, 'Y' FROM d2 h LEFT JOIN k ON h.{key} = k.key WHERE {gone}""")


def _terminals_full() -> str:
    own = "h.terminal_type, h.terminal_city, h.terminal_address"
    gone = f"k.terminal_id IS NULL AND h.effective_to = {OPEN} AND h.deleted_flg = 'N'"
    inner = SQL["snapshot_scd2"]
    return f"""WITH loaded AS ({inner}), file AS ({with_views('SELECT terminal_id FROM term_file', 'term_file')})
SELECT h.terminal_id, {own}, h.effective_from, CASE WHEN {gone} THEN {DT_NEXT} ELSE h.effective_to END AS effective_to, h.deleted_flg
FROM loaded h LEFT JOIN (SELECT DISTINCT terminal_id FROM file) k ON h.terminal_id = k.terminal_id
UNION ALL SELECT h.terminal_id, {own}, {DT}, {OPEN}, 'Y'
FROM loaded h LEFT JOIN (SELECT DISTINCT terminal_id FROM file) k ON h.terminal_id = k.terminal_id WHERE {gone}"""


SQL: dict[str, str] = {
    "parse_transactions": with_views(
        """SELECT transaction_id, date_trunc('second', transaction_date) AS transaction_date, amount, card_num, oper_type,
            oper_result, terminal, date_trunc('day', transaction_date)::TIMESTAMP AS load_dt FROM stg_tx""", "stg_tx"),
    "parse_terminals": with_views("SELECT terminal_id, terminal_type, terminal_city, terminal_address FROM term_file", "term_file"),
    "parse_blacklist": with_views("SELECT entry_dt, passport_num FROM bl", "bl"),
    "in_list_with_nulls": with_views(
        f"""SELECT client_id, first_name, first_name IN (SELECT CASE WHEN entry_dt > {BLACKLIST_WM} THEN passport_num END FROM bl)
            AS listed FROM cl""", "cl", "bl"),
    "in_empty_list": with_views(
        f"SELECT client_id, first_name, first_name IN (SELECT passport_num FROM bl WHERE entry_dt > {OPEN}) AS listed FROM cl",
        "cl", "bl"),
    "rule_amount_probing_20min": with_views("SELECT 1", "tx_dense").replace(
        "\nSELECT 1", f", t20 AS ({_TRIPLES_20}) SELECT max(a_dt) AS anchor_dt FROM t20"),
    "rule_amount_probing_20min_per_card": with_views("SELECT 1", "tx_dense").replace(
        "\nSELECT 1", f", t20 AS ({_TRIPLES_20}) SELECT DISTINCT c_id AS trans_id FROM t20"),
    "scd2_full_accounts": _scd2_full("acc_hist", "acc_src", "account_num", "account", {"valid_to": "valid_to", "client": "client"}),
    "scd2_full_cards": _scd2_full("cards_hist", "cards_src", "card_num", "card_num", {"account_num": "account"}),
    "incremental_extract": with_views("SELECT * FROM delta", "delta"),
    "key_snapshot": with_views("SELECT client_id FROM src_all", "src_all"),
    "scd2_insert": with_views("SELECT * FROM h1", "h1"),
    "scd2_close": with_views(
        "SELECT * FROM h2",
        "h2",
    ).replace("FROM h1 h LEFT JOIN delta", "FROM hist h LEFT JOIN delta"),
    "scd2_delete": _scd2_delete(DT_NEXT),
    "scd2_delete_corrected": _scd2_delete(DT_PREV),
    "scd2_full": with_views("SELECT * FROM h3", "h3"),
    "scd2_full_corrected": with_views("SELECT * FROM h3c", "h3c"),
    "snapshot_scd2": with_views(_SNAPSHOT_LITERAL, "term_hist", "term_file"),
    "snapshot_scd2_corrected": with_views(_SNAPSHOT_CORRECTED, "term_hist", "term_file"),
    "load_fact_transactions": with_views(
        """SELECT CAST(transaction_id AS BIGINT) AS trans_id, transaction_date AS trans_date, card_num, oper_type,
        CAST(amount AS DECIMAL(10,2)) AS amt, oper_result, terminal FROM stg_tx""", "stg_tx"),
    "load_fact_blacklist": with_views(f"SELECT entry_dt, passport_num FROM bl WHERE entry_dt > {BLACKLIST_WM}", "bl"),
    "advance_watermarks": _with_meta("SELECT last_update_dt, dbname, table_name FROM advanced"),
    "read_watermark": _with_meta(
        "SELECT table_name, last_update_dt FROM advanced WHERE dbname = 'dwh' AND table_name = 'dim_clients_hist'"),
    "dim_chain_join": with_views(
        """SELECT trans_id, trans_date, card_num, dim_card_num, account_num, valid_to, client_id, passport_num,
        passport_valid_to, phone FROM chain""", "chain"),
    "asof_join": with_views(
        f"""SELECT trans_id, trans_date, account_num, client_id, passport_valid_to, client_effective_from
        FROM ({_ASOF}) j""", "tx", "cards_hist", "acc_hist", "h3"),
    "anti_join_missing_keys": with_views(
        f"""SELECT h.client_id, h.effective_from FROM hist h LEFT JOIN keys k ON h.client_id = k.client_id
        WHERE k.client_id IS NULL AND h.effective_to = {OPEN} AND h.deleted_flg = 'N'""", "hist", "keys"),
    "in_blacklist_flag": with_views(
        "SELECT client_id, passport_num, passport_num IN (SELECT passport_num FROM bl) AS in_blacklist FROM cl",
        "cl", "bl"),
    "rule_passport": with_views(f"SELECT trans_id FROM chain WHERE {_R1}", "chain", "bl"),
    "rule_passport_corrected": with_views(f"SELECT trans_id FROM chain j WHERE {_R1_CORRECTED}", "chain", "bl"),
    "rule_contract": with_views(f"SELECT trans_id FROM chain WHERE valid_to < {DT}", "chain"),
    "rule_contract_corrected": with_views("SELECT trans_id FROM chain WHERE valid_to < trans_date", "chain"),
    "rule_city_velocity": with_views("SELECT max(a_dt) AS anchor_dt FROM r3_pairs", "r3_pairs"),
    "rule_city_velocity_per_card": with_views("SELECT DISTINCT b_id AS trans_id FROM r3_pairs", "r3_pairs"),
    "rule_amount_probing": with_views("SELECT max(a_dt) AS anchor_dt FROM r4_triples", "r4_triples"),
    "rule_amount_probing_per_card": with_views("SELECT DISTINCT c_id AS trans_id FROM r4_triples", "r4_triples"),
    "classify": with_views(
        f"SELECT trans_id, event_type FROM ({_classified(_R3_LITERAL, _R4_LITERAL)}) x",
        "chain", "bl", "r3_pairs", "r4_triples"),
    "classify_per_card": with_views(
        f"SELECT trans_id, event_type FROM ({_classified(_R3_CARD, _R4_CARD)}) x",
        "chain", "bl", "r3_pairs", "r4_triples"),
    "fraud_report": with_views(_report(_classified(_R3_LITERAL, _R4_LITERAL)),
                               "chain", "bl", "r3_pairs", "r4_triples"),
    "fraud_report_asof": with_views(
        _report(f"""SELECT j.trans_id, j.trans_date, j.passport_num, j.last_name, j.first_name, j.patronymic, j.phone,
            {_case(_R1_CORRECTED, 'j.valid_to < j.trans_date', _R3_CARD.replace('trans_id', 'j.trans_id'),
                   _R4_CARD.replace('trans_id', 'j.trans_id'))} AS event_type
            FROM ({_ASOF}) j WHERE j.trans_date > {DT}"""),
        "tx", "cards_hist", "acc_hist", "h3", "bl", "r3_pairs", "r4_triples"),
    "fio_concat_nulls": with_views(f"SELECT client_id, {_FIO} AS fio FROM cl", "cl"),
    "trimmed_key_join": with_views(
        "SELECT tx.trans_id, c.account_num FROM tx LEFT JOIN cards c ON tx.card_num = RTRIM(c.card_num)",
        "tx", "cards"),
}

SQL["terminals_full"] = _terminals_full()
SQL["asof_join_versions"] = (
    with_views("SELECT 1", "tx", "h3")
    .replace("\nSELECT 1", f",\nch AS ({SQL['scd2_full_cards']}),\nah AS ({SQL['scd2_full_accounts']})\n" + """
SELECT trans_id, trans_date, account_num, client_id, passport_valid_to, client_effective_from FROM ("""
             + _ASOF.replace("cards_hist", "ch").replace("acc_hist", "ah") + ") x")
)
SQL["advance_watermarks_empty_feed"] = _with_meta(f"""SELECT CASE table_name WHEN 'fact_passport_blacklist'
        THEN (SELECT max(entry_dt) FROM bl WHERE entry_dt > {OPEN})
        WHEN 'fact_transactions' THEN (SELECT max(transaction_date) FROM stg_tx) ELSE last_update_dt END AS last_update_dt,
    dbname, table_name FROM meta""")
SQL["missing_keys_by_digest"] = SQL["anti_join_missing_keys"]
SQL["scd2_delete_by_digest"] = SQL["scd2_delete"]
