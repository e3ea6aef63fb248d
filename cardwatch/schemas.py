"""Table schemas, sentinels and event-type codes of the warehouse.

All date-like columns are ``timestamp_ntz``: the source dialect's DATE keeps
the time of day to the second and carries no zone.  Keys are strings (the
source declares them as variable-length text), amounts are decimal(10,2).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# open end of a version, and the "beginning of time" used for empty watermarks
OPEN_END = _dt.datetime(5999, 12, 31)
BEGINNING = _dt.datetime(1899, 1, 1)
# deleted flag values
FLAG_LIVE = "N"
FLAG_DELETED = "Y"
# reject / success values of oper_result
RESULT_REJECT = "REJECT"
RESULT_SUCCESS = "SUCCESS"
# default rule windows: different cities within one hour, amount probing within 20 minutes
CITY_WINDOW = _dt.timedelta(hours=1)
PROBE_WINDOW = _dt.timedelta(minutes=20)


class EventType:
    """Report event types (codes) and the labels the reference stores."""

    PASSPORT_INVALID = "PASSPORT_INVALID"
    CONTRACT_EXPIRED = "CONTRACT_EXPIRED"
    CITY_VELOCITY = "CITY_VELOCITY"
    AMOUNT_PROBING = "AMOUNT_PROBING"
    OK = "OK"

    # The reference's labels, in rule order, then the label of a
    # correct operation.
    LABELS = {
        "PASSPORT_INVALID": "Совершение операции при просроченном или заблокированном паспорте",
        "CONTRACT_EXPIRED": "Совершение операции при недействующем договоре",
        "CITY_VELOCITY": "Совершение операции в разных городах в течение одного часа",
        "AMOUNT_PROBING": "Попытка подбора суммы",
        "OK": "Корректная транзакция",
    }


def _s(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.StringType(), True) for n in names]


def _ts(*names: str) -> list[T.StructField]:
    return [T.StructField(n, T.TimestampNTZType(), True) for n in names]


AMOUNT = T.DecimalType(10, 2)

# --- feeds -----------------------------------------------------------------
STG_TRANSACTIONS = T.StructType(
    _s("transaction_id")
    + _ts("transaction_date")
    + [T.StructField("amount", AMOUNT, True)]
    + _s("card_num", "oper_type", "oper_result", "terminal")
)
STG_TERMINALS = T.StructType(_s("terminal_id", "terminal_type", "terminal_city", "terminal_address"))
STG_PASSPORT_BLACKLIST = T.StructType(_ts("entry_dt") + _s("passport_num"))

# --- source tables (current state) ------------------------------------------
SRC_ACCOUNTS = T.StructType(_s("account") + _ts("valid_to") + _s("client") + _ts("create_dt", "update_dt"))
SRC_CARDS = T.StructType(_s("card_num", "account") + _ts("create_dt", "update_dt"))
SRC_CLIENTS = T.StructType(
    _s("client_id", "last_name", "first_name", "patronymic")
    + _ts("date_of_birth")
    + _s("passport_num")
    + _ts("passport_valid_to")
    + _s("phone")
    + _ts("create_dt", "update_dt")
)

# --- warehouse ---------------------------------------------------------------
_VERSION = _ts("effective_from", "effective_to") + _s("deleted_flg")
DIM_ACCOUNTS_HIST = T.StructType(_s("account_num") + _ts("valid_to") + _s("client") + _VERSION)
DIM_CARDS_HIST = T.StructType(_s("card_num", "account_num") + _VERSION)
DIM_CLIENTS_HIST = T.StructType(
    _s("client_id", "last_name", "first_name", "patronymic")
    + _ts("date_of_birth")
    + _s("passport_num")
    + _ts("passport_valid_to")
    + _s("phone")
    + _VERSION
)
DIM_TERMINALS_HIST = T.StructType(
    _s("terminal_id", "terminal_type", "terminal_city", "terminal_address") + _VERSION
)
FACT_TRANSACTIONS = T.StructType(
    [T.StructField("trans_id", T.LongType(), True)]
    + _ts("trans_date")
    + _s("card_num", "oper_type")
    + [T.StructField("amt", AMOUNT, True)]
    + _s("oper_result", "terminal")
)
FACT_PASSPORT_BLACKLIST = T.StructType(_ts("entry_dt") + _s("passport_num"))
META_DATA = T.StructType(_ts("last_update_dt") + _s("dbname", "table_name"))
REP_FRAUD = T.StructType(
    _ts("event_dt") + _s("passport", "fio", "phone", "event_type") + _ts("report_dt")
)

# --- load watermarks ----------------------------------------------------------
META_DB = "dwh"
WM_ACCOUNTS = "dim_accounts_hist"
WM_CARDS = "dim_cards_hist"
WM_CLIENTS = "dim_clients_hist"
WM_TERMINALS = "dim_terminals_hist"
WM_TRANSACTIONS = "fact_transactions"
WM_BLACKLIST = "fact_passport_blacklist"
WATERMARK_TABLES = (WM_ACCOUNTS, WM_CARDS, WM_CLIENTS, WM_TERMINALS, WM_TRANSACTIONS, WM_BLACKLIST)

#: Lines of text feeds that could not be loaded.
REJECTS = T.StructType([
    T.StructField("feed", T.StringType(), False),
    T.StructField("file_name", T.StringType(), True),
    T.StructField("line", T.StringType(), True),
    T.StructField("reason", T.StringType(), False),
])
