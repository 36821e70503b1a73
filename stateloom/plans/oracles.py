"""The registered queries as DuckDB SQL over the same tables, for side-by-side comparison."""

from __future__ import annotations


def _load_key(texts: dict[str, str]) -> str:
    """md5 over `length:value` pieces in name order; `texts` maps a name to its text expression."""
    pieces = []
    for name in sorted(texts):
        value = f"coalesce({texts[name]}, '<NULL>')"
        pieces.append(f"concat(length({value}), ':', {value})")
    return f"md5(concat_ws('|', {', '.join(pieces)}))"


FEED_COLUMNS = [
    "Дата операции", "Дата платежа", "Номер карты", "Статус", "Сумма операции", "Валюта операции", "Сумма платежа",
    "Валюта платежа", "Кэшбэк", "Категория", "MCC", "Описание", "Бонусы (включая кэшбэк)",
    "Округление на инвесткопилку", "Сумма операции с округлением",
]


def _comma(amount: str) -> str:
    return f"replace(cast(cast({amount} as decimal(18,2)) as varchar), '.', ',')"


_AMOUNT = _comma("case when o_orderkey % 2 = 0 then -o_totalprice else o_totalprice end")
_REWARD = _comma("o_orderkey % 3")
_ROUNDED = _comma("case when o_orderstatus = 'P' then ceil(abs(o_totalprice)) else abs(o_totalprice) end")

FEED = f"""
feed as (
  select
    strftime(o_orderdate + to_seconds(o_orderkey % 86400), '%d.%m.%Y %H:%M:%S') as "Дата операции",
    strftime(o_orderdate, '%d.%m.%Y') as "Дата платежа",
    case when o_custkey % 5 <> 0 then '*' || lpad(cast(o_custkey % 10000 as varchar), 4, '0') end as "Номер карты",
    case when o_orderstatus = 'F' then 'FAILED' else 'OK' end as "Статус",
    {_AMOUNT} as "Сумма операции",
    'RUB' as "Валюта операции",
    {_AMOUNT} as "Сумма платежа",
    case when o_orderpriority = '5-LOW' then 'USD' else 'RUB' end as "Валюта платежа",
    case when o_orderkey % 3 > 0 then cast(o_orderkey % 3 as varchar) end as "Кэшбэк",
    o_orderpriority as "Категория",
    case when o_custkey % 5 <> 0 then lpad(cast(o_custkey % 10000 as varchar), 4, '0') end as "MCC",
    'order ' || o_orderkey as "Описание",
    {_REWARD} as "Бонусы (включая кэшбэк)",
    '0,00' as "Округление на инвесткопилку",
    {_ROUNDED} as "Сумма операции с округлением"
  from orders
)"""

_RUN = "timestamp '2024-02-01 00:00:00'"
_LOCAL = """((strptime("Дата операции", '%d.%m.%Y %H:%M:%S') at time zone 'Europe/Moscow') at time zone 'UTC')"""


def _number(name: str) -> str:
    return f"""cast(replace("{name}", ',', '.') as double)"""


STAGED = f"""{FEED},
staged as (
  select
    {_load_key({c: f'"{c}"' for c in FEED_COLUMNS})} as __load_key,
    "Номер карты" as card_last4,
    cast("Кэшбэк" as integer) as cashback_amt,
    "Категория" as category_nm,
    "Описание" as description,
    "MCC" as mcc_cd,
    {_number("Сумма платежа")} as merchant_amt,
    "Валюта платежа" as merchant_currency_cd,
    cast(strptime("Дата платежа", '%d.%m.%Y') as date) as posted_on,
    {_number("Сумма операции с округлением")} as rounded_transaction_amt,
    {_number("Округление на инвесткопилку")} as savings_jar_amt,
    "Статус" as status_nm,
    {_number("Бонусы (включая кэшбэк)")} as total_rewards_amt,
    {_LOCAL} as transacted_at_utc,
    {_number("Сумма операции")} as transaction_amt,
    "Валюта операции" as transaction_currency_cd,
    {_RUN} as __ingested_at
  from feed
)"""

_BUSINESS_KEY = (
    "md5(concat_ws('|', 't_bank', transacted_at_utc, transaction_amt, coalesce(card_last4, 'no_card_last4')))"
)

CORE = f"""{STAGED},
core as (
  select {_BUSINESS_KEY} as transaction_bk, card_last4, status_nm, category_nm, description, transaction_amt,
    transaction_currency_cd, transacted_at_utc, total_rewards_amt, {_RUN} as __ingested_at
  from staged
)"""

# the outer zone makes the session's own zone irrelevant
_LITERAL_DATE = "cast((({ts}) at time zone 'Europe/Moscow') at time zone 'UTC' as date)"

MART = f"""{CORE},
mart as (
  select transaction_bk, category_nm, description, transaction_amt, transaction_currency_cd, transacted_at_utc,
    {_LITERAL_DATE.format(ts="transacted_at_utc")} as transaction_dt, total_rewards_amt, {_RUN} as __ingested_at
  from core where status_nm = 'OK'
)"""

VIEW = f"""{MART},
bank_view as (
  select 'T Bank' as bank_nm, category_nm, description, transaction_amt, transaction_currency_cd, transaction_dt
  from mart
  union all
  select 'T Bank', 'Cashback', 'Cashback and other rewards', total_rewards_amt, transaction_currency_cd, transaction_dt
  from mart where total_rewards_amt > 0
)"""

_VIEW_TEXTS = {
    "bank_nm": "bank_nm", "category_nm": "category_nm", "description": "description",
    "transaction_amt": "cast(transaction_amt as varchar)", "transaction_currency_cd": "transaction_currency_cd",
    "transaction_dt": "cast(transaction_dt as varchar)",
}

_ORDER = "cast(split_part(description, ' ', 2) as bigint)"

_MIDDLE = """
middle as (
  select cast(min(ts)::date + cast(date_diff('day', min(ts)::date, max(ts)::date) // 2 as integer) as timestamp) as mid
  from events
)"""

_EVENT_KEY = _load_key(
    {"event_id": "cast(event_id as varchar)", "ts": "cast(ts as varchar)", "user_id": "cast(user_id as varchar)",
     "event_type": "event_type", "value": "cast(value as varchar)", "props": "props"}
)

_PAGES = """
files as (select page_id, url as src_path, md5(html) as md5 from pages),
ledger as (
  select url as src_path, case when length(html) % 2 = 1 then md5(html || 'x') else md5(html) end as md5
  from pages where url like 'https:%'
)"""

_DOCUMENT_LEDGER = """
ledger as (
  select source as bank, lang as table_name, doc_id || '.csv' as file_name,
    'To Parse/Bank/' || source || '/' || lang || '/' || doc_id || '.csv' as src_path,
    n_chars as size, md5(text) as md5,
    timestamp '2024-01-01 00:00:00' + to_seconds(doc_id) as ingested_at,
    case when lang = 'en' then timestamp '2024-01-01 01:00:00' + to_seconds(doc_id) end as archived_at
  from documents
)"""


def _check(name: str, column: str, failures: str, severity: str = "error") -> str:
    return (
        f"select '{name}' as check_name, '{column}' as column_name, '{severity}' as severity, "
        f"cast({failures} as bigint) as failures, ({failures}) = 0 as passed"
    )


def _decimal_check(name: str) -> str:
    return f"""coalesce(try_cast(replace(replace("{name}", ' ', ''), ',', '.') as decimal(18,2)), 0)"""


_DUPLICATES = "(select count(*) from (select {c} from events where {c} is not null group by 1 having count(*) > 1))"
_EVENT_COUNT = "(select count(*) from events where {where})"
_RULE_COUNT = "(select count(*) from checked where not coalesce({rule}, true))"
_KINDS = "('page_view', 'click', 'purchase', 'signup')"

_NULLABLE = [
    "__load_key", "card_last4", "cashback_amt", "category_nm", "description", "mcc_cd", "merchant_amt",
    "merchant_currency_cd", "posted_on", "rounded_transaction_amt", "savings_jar_amt", "status_nm",
    "total_rewards_amt", "transacted_at_utc", "transaction_amt", "transaction_currency_cd", "__ingested_at",
]

ORACLES: dict[str, str] = {
    "scan_table": "select * from orders",
    "normalize_identifier": """
select p_partkey, coalesce(nullif(trim(regexp_replace(regexp_replace(
  lower(p_brand || '_' || p_type), '[^a-z0-9_]', '_', 'g'), '_+', '_', 'g'), '_'), ''), 'unknown') as table_name
from part""",
    "snapshot_manifest": f"""with {VIEW}
select count(*) as row_count,
  cast(coalesce(sum(cast('0x' || substr({_load_key(_VIEW_TEXTS)}, 1, 15) as bigint)), 0) as varchar) as row_checksum
from bank_view""",
    "bookmark_delta": f"""with {_MIDDLE},
mark as (select ts as last_ts, event_id as last_id from events where ts < (select mid from middle)
  order by ts desc, event_id desc limit 1)
select event_id, ts, user_id, event_type, value from events, mark
where ts > last_ts or (ts = last_ts and event_id > last_id)""",
    "load_key_customer": "select c_custkey, " + _load_key({
        "c_custkey": "cast(c_custkey as varchar)", "c_name": "c_name", "c_nationkey": "cast(c_nationkey as varchar)",
        "c_acctbal": "cast(c_acctbal as varchar)", "c_mktsegment": "c_mktsegment",
    }) + " as load_key from customer",
    "load_key_documents": "select doc_id, " + _load_key({
        "doc_id": "cast(doc_id as varchar)", "text": "text", "lang": "lang", "source": "source",
        "n_chars": "cast(n_chars as varchar)",
    }) + " as load_key from documents",
    "load_key_events": f"select event_id, {_EVENT_KEY} as load_key from events",
    "align_schema": """
select cast(c_custkey as varchar) as custkey, c_name as name, cast(c_nationkey as varchar) as nationkey,
  cast(c_acctbal as varchar) as acctbal, c_mktsegment as mktsegment from customer
union all
select cast(null as varchar), s_name, cast(s_nationkey as varchar), cast(s_acctbal as varchar), cast(null as varchar)
from supplier""",
    "mapped_projection": f"with {STAGED} select * from staged",
    "decimal_comma_parse": f"""with {FEED}
select "Описание" as description, {_number("Сумма операции")} as amount,
  {_number("Бонусы (включая кэшбэк)")} as reward from feed""",
    "local_text_to_utc": f"""with {FEED} select "Описание" as description, {_LOCAL} as occurred_at from feed""",
    "date_text_parse": f"""with {FEED}
select "Описание" as description, cast(strptime("Дата платежа", '%d.%m.%Y') as date) as posted_on from feed""",
    "int_text_parse": """
select p_partkey, cast(cast(p_size as varchar) as integer) as size_int,
  cast(cast(p_retailprice as varchar) as integer) as price_int from part""",
    "display_projection": f"""with {VIEW}
select transaction_dt as "Date", bank_nm as "Bank Name", category_nm as "Category", description as "Description",
  transaction_amt as "Amount, Currency", transaction_currency_cd as "Currency" from bank_view""",
    "stringify_cells": """
select cast(event_id as varchar) as event_id,
  case when epoch_us(ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S')
    else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end as ts,
  strftime(ts, '%Y-%m-%d') as day,
  coalesce(case when event_type <> 'error' then event_type end, 'None') as event_type,
  coalesce(cast(value as varchar), 'None') as value
from events""",
    "display_projection_tolerant": f"""with {VIEW}
select cast(transaction_dt as varchar) as "Date", bank_nm as "Bank Name", coalesce(category_nm, 'None') as "Category",
  '' as "Description", cast(transaction_amt as varchar) as "Amount, Currency", '' as "Currency" from bank_view""",
    "business_key": f"with {STAGED} select description, {_BUSINESS_KEY} as transaction_bk from staged",
    "business_key_large": """
select o_orderkey, cast(o_totalprice * 1000 as varchar) as amount_text,
  md5(concat_ws('|', 't_bank', o_orderdate, o_totalprice * 1000, 'no_card_last4')) as transaction_bk from orders""",
    "local_date_literal": f"select event_id, {_LITERAL_DATE.format(ts='ts')} as local_dt from events",
    "local_date_documented": """
select event_id, cast((ts at time zone 'UTC') at time zone 'Europe/Moscow' as date) as local_dt from events""",
    "events_export_layout": """
select event_id as id, user_id, event_type, ts as updated_at, value as metric_1 from events""",
    "status_filter": f"with {STAGED} select description, status_nm from staged where status_nm = 'OK'",
    "pending_archive": f"""with {_DOCUMENT_LEDGER}
select src_path, bank, file_name, md5, replace(src_path, 'To Parse', 'Archive') as archived_path, ingested_at
from ledger where archived_at is null order by ingested_at""",
    "incremental_lookback": f"""with {_MIDDLE},
own as (select ts from events where ts < (select mid from middle))
select event_id, ts, user_id, event_type, value from events
where ts >= (select coalesce(max(ts), timestamp '1900-01-02 00:00:00') - interval '1 day' from own)""",
    "anti_join_new_rows": f"""with {_MIDDLE},
keyed as (select event_id, ts, {_EVENT_KEY} as __load_key from events),
stored as (select __load_key from keyed where ts < (select mid from middle))
select event_id, __load_key from keyed
where not exists (select 1 from stored where stored.__load_key = keyed.__load_key)""",
    "ledger_anti_join": f"""with {_PAGES}
select page_id, src_path, md5 from files f
where not exists (select 1 from ledger l where l.src_path = f.src_path and l.md5 = f.md5)""",
    "ledger_semi_join": f"""with {_PAGES}
select page_id, src_path, md5 from files f
where exists (select 1 from ledger l where l.src_path = f.src_path and l.md5 = f.md5)""",
    "ledger_summary": f"""with {_PAGES},
flagged as (select exists (select 1 from ledger l where l.src_path = f.src_path and l.md5 = f.md5) as known from files f)
select count(*) filter (not known) as ingested, count(*) filter (known) as skipped from flagged""",
    "referential_integrity": """
select count(*) as total_rows, count(case when c_custkey is not null then 1 end) as valid_references,
  count(case when c_custkey is null then 1 end) as invalid_references
from orders left join customer on o_custkey + 100 = c_custkey""",
    "keyed_update": f"""with {_DOCUMENT_LEDGER}
select file_name, md5, ingested_at,
  case when file_name in (select doc_id || '.csv' from labels) then {_RUN} else archived_at end as archived_at
from ledger""",
    "core_model": f"with {CORE} select * from core",
    "mart_model": f"with {MART} select * from mart",
    "union_reward_rows": f"with {VIEW} select * from bank_view",
    "distinct_per_file": "select distinct source, lang, text from documents",
    "delete_insert_upsert": """
with target as (select o_orderkey, o_custkey, o_totalprice, o_orderdate from orders
  where o_orderdate < timestamp '1998-06-01 00:00:00'),
batch as (select o_orderkey, o_custkey, o_totalprice + 1 as o_totalprice, o_orderdate from orders
  where o_orderdate >= timestamp '1998-05-01 00:00:00')
select * from target where o_orderkey not in (select o_orderkey from batch) union all select * from batch""",
    "staging_incremental": f"""with {STAGED}
select * from staged where __load_key not in (select __load_key from staged where {_ORDER} % 2 = 0)""",
    "core_incremental": f"""with {CORE},
stored as (select * replace ({_RUN} - interval 3 days as __ingested_at) from core where {_ORDER} % 3 <> 0),
batch as (select * replace ('changed' as category_nm) from core where {_ORDER} % 2 = 0)
select * from stored where transaction_bk not in (select transaction_bk from batch) union all select * from batch""",
    "mart_incremental": f"""with {MART},
batch as (select * replace ('changed' as category_nm) from mart where {_ORDER} % 4 = 2)
select * replace ({_RUN} - interval 3 days as __ingested_at) from mart
where transaction_bk not in (select transaction_bk from batch) union all select * from batch""",
    "display_rows": f"""with {VIEW}
select coalesce(cast(transaction_dt as varchar), 'None') as "Date", bank_nm as "Bank Name", coalesce(category_nm, 'None') as "Category",
  coalesce(description, 'None') as "Description", coalesce(cast(transaction_amt as varchar), 'None') as "Amount, Currency",
  coalesce(transaction_currency_cd, 'None') as "Currency" from bank_view""",
    "snapshot_fold": """
select count(*) as parts, md5(concat_ws('|', count(*), coalesce(sum(cast('0x' || substr(md5(html), 1, 15) as bigint)), 0),
  coalesce(sum(cast('0x' || substr(md5(html), 17, 15) as bigint)), 0))) as md5 from pages""",
    "backfill_range": """
select event_id, ts, user_id, event_type, value from events
where cast(ts as date) between date '2024-01-10' and date '2024-01-12'""",
    "dq_completeness": f"""with {STAGED}
select count(*) as total_rows, count(card_last4) as card_last4_complete, count(mcc_cd) as mcc_cd_complete,
  count(cashback_amt) as cashback_amt_complete, count(description) as description_complete from staged""",
    "dq_metrics": f"""with {STAGED}
select count(*) as total_rows, round(count(card_last4) / count(*)::decimal, 4) as card_last4_completeness,
  round(count(cashback_amt) / count(*)::decimal, 4) as cashback_amt_completeness,
  round(count(status_nm) / count(*)::decimal, 4) as status_nm_completeness,
  round(avg(transaction_amt), 4) as avg_transaction_amt, round(stddev(transaction_amt), 4) as transaction_amt_stddev
from staged""",
    "dq_range": """
select min(l_extendedprice) as min_l_extendedprice, max(l_extendedprice) as max_l_extendedprice,
  min(l_discount) as min_l_discount, max(l_discount) as max_l_discount,
  count(case when l_discount < 0 or l_discount > 0.05 then 1 end) as invalid_discounts from lineitem""",
    "dq_uniqueness": """
select count(distinct doc_id) as unique_doc_id, count(distinct text) as unique_text, count(*) as total_rows
from documents""",
    "export_contract_counts": f"""with {FEED}
select count(case when {_decimal_check("Сумма операции")} < 0 then 1 end) as debit_rows,
  count(case when {_decimal_check("Кэшбэк")} > 0 then 1 end) as cashback_rows from feed""",
    "dq_not_null": f"with {STAGED} " + " union all ".join(
        f"select '{c}' as column_name, count(*) filter ({c} is null) as null_rows from staged" for c in _NULLABLE
    ),
    "dq_unique": "select l_orderkey, count(*) as n_records from lineitem where l_orderkey is not null group by 1 having count(*) > 1",
    "dq_accepted_values": f"""
select event_type as value_field, count(*) as n_records from events
where event_type not in {_KINDS} group by 1""",
    "dq_expectations": " union all ".join(
        [
            _check("exists", "event_id", "0"),
            _check("exists", "metric_2", "1"),
            _check("not_null", "event_id", _EVENT_COUNT.format(where="event_id is null")),
            _check("not_null", "user_id", _EVENT_COUNT.format(where="user_id is null")),
            _check("not_null", "event_type", _EVENT_COUNT.format(where="event_type is null")),
            _check("in_set", "event_type", _EVENT_COUNT.format(where=f"event_type not in {_KINDS}")),
            _check("between", "value", _EVENT_COUNT.format(where="value < 0 or value > 1000")),
            _check("between", "user_id", _EVENT_COUNT.format(where="user_id < 100"), "warn"),
            _check("unique", "event_id", _DUPLICATES.format(c="event_id")),
            _check("unique", "user_id", _DUPLICATES.format(c="user_id"), "warn"),
        ]
    ),
    "dq_row_rules": f"""with {FEED},
checked as (
  select {_decimal_check("Сумма операции")} as amount, {_decimal_check("Сумма платежа")} as payment,
    {_decimal_check("Сумма операции с округлением")} as rounded,
    {_decimal_check("Бонусы (включая кэшбэк)")} as bonuses,
    "Валюта операции" as currency, "Валюта платежа" as payment_currency, "MCC" as mcc
  from feed
)
""" + " union all ".join(
        _check("rule", name, _RULE_COUNT.format(rule=rule))
        for name, rule in {
            "payment_equals_amount": "payment = amount",
            "rounded_is_size": "rounded = abs(amount)",
            "currencies_align": "currency = payment_currency",
            "mcc_is_digits": "(mcc is null or mcc = '' or regexp_full_match(mcc, '[0-9]+'))",
            "bonuses_not_negative": "bonuses >= 0",
        }.items()
    ),
    "quarantine_bad_values": f"""with {FEED},
rows as (
  select cast(split_part("Описание", ' ', 2) as bigint) as order_key, "Сумма операции" as amount, "Описание" as descr
  from feed
),
junk as (
  select order_key,
    case when order_key % 97 = 0 then 'invalid' when order_key % 89 = 0 then amount || 'd'
      when order_key % 79 = 0 then '0x1p3' else amount end as amount,
    case when order_key % 83 <> 0 then descr else ' ' end as description
  from rows
),
parsed as (select *, try_cast(replace(amount, ',', '.') as double) as parsed from junk)
select order_key, amount, description,
  concat_ws(',', case when amount is not null and parsed is null then 'amount' end,
    case when description is null or trim(description) = '' then 'description' end) as problems,
  parsed
from parsed""",
    "retention_top_n": """
with folders as (
  select event_type as dataset, strftime(ts, '%Y%m%d') as folder, max(ts) as modified_at from events group by all
)
select *, case when row_number() over (partition by dataset order by modified_at desc, folder desc) <= 10
  then 'keep' else 'delete' end as action
from folders""",
    "dialect_files": """
select cast(o_orderkey as varchar) as order_key, o_orderstatus as status,
  o_orderpriority || '; it''s "' || cast(o_custkey as varchar) || '", ' || o_orderstatus as note
from orders""",
    "latest_copy": "select c_custkey, ' ' || c_name || ' ' as name, cast(c_acctbal as double) as c_acctbal from customer",
    "outbox_second_batch": """
select event_id, case when event_id % 7 = 0 then upper(event_type) else event_type end as event_type, cast(user_id as varchar) as user_text
from events where event_id % 2 <> 0 or event_id % 7 = 0""",
    "dq_unique_added": """
select l_orderkey, count(*) filter (where not coalesce(l_shipdate >= timestamp '1998-01-01', false)) as n_stored,
  count(*) filter (where l_shipdate >= timestamp '1998-01-01') as n_added
from lineitem where l_orderkey is not null
group by l_orderkey having count(*) > 1 and count(*) filter (where l_shipdate >= timestamp '1998-01-01') > 0""",
    "running_profile": """
select count(*) as total_rows, count(distinct event_id) as unique_event_id, count(event_type) as event_type_complete,
  count(value) as value_complete, count(ts) as ts_complete, min(event_type) as min_event_type, max(event_type) as max_event_type,
  min(value) as min_value, max(value) as max_value, min(ts) as min_ts, max(ts) as max_ts,
  round(avg(value), 6) as avg_value, round(stddev(value), 6) as value_stddev
from events""",
}
