"""The registered queries again as plain SQL, for a second engine to compare against.

Named pieces are put in front of a query as common table expressions when its text mentions them.
"""

from __future__ import annotations

import re

from testbed.queries import OUTPUT

SQL_TYPES = {"s": "varchar", "b": "boolean", "l": "bigint", "d": "double", "t": "timestamp", "a": "date"}

STATUS = """case upper(trim(status))
    when 'C' then 'Completed' when 'COMP' then 'Completed' when 'COMPLETED' then 'Completed'
    when 'P' then 'Pending' when 'PEND' then 'Pending' when 'PENDING' then 'Pending'
    when 'X' then 'Cancelled' when 'CANC' then 'Cancelled' when 'CANCELLED' then 'Cancelled'
    when 'R' then 'Refunded' when 'REFD' then 'Refunded' else 'Unknown' end"""

REGION = """case r_name when 'AMERICA' then 'AMER' when 'EUROPE' then 'EMEA' when 'AFRICA' then 'EMEA'
    when 'ASIA' then 'APAC' end"""

CURRENCY = """case n_nationkey % 5 when 0 then 'USD' when 1 then 'EUR' when 2 then 'GBP' when 3 then 'CAD'
    else 'JPY' end"""

NEWEST = "_ingestion_ts desc nulls last, total_amount desc nulls last, product_id desc nulls last, " \
         "status desc nulls last, quantity desc nulls last, sales_rep_id desc nulls last"

RUN_1, RUN_2 = "timestamp '2002-01-01 04:00:00'", "timestamp '2002-01-02 04:00:00'"
CUT = "timestamp '1998-06-01 00:00:00'"
RUN_ID = "RUN-20020101-040000"

PARTS: dict[str, str] = {}

PARTS["bronze"] = f"""
  select 'ORD-' || l_orderkey || '-' || l_linenumber as order_id,
    cast(o_orderdate as date) as order_date,
    'CUST-' || o_custkey as customer_id,
    'PROD-' || l_partkey as product_id,
    cast(l_quantity as decimal(18,4)) as quantity,
    cast(p_retailprice as decimal(18,4)) as unit_price,
    cast(l_extendedprice as decimal(18,4)) as total_amount,
    {CURRENCY} as currency,
    case when l_suppkey % 50 = 0 then '??' when l_returnflag = 'R' then 'REFD'
         when o_orderstatus = 'F' then ' comp ' when o_orderstatus = 'O' then 'PEND' else 'x' end as status,
    {REGION} as region,
    case when l_suppkey % 10 <> 0 then 'REP-' || l_suppkey end as sales_rep_id,
    cast(l_shipdate as timestamp) as _ingestion_ts,
    cast(l_shipdate as date) as ingestion_date
  from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey
    join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
    join part on l_partkey = p_partkey"""

PARTS["numbered"] = "select *, cast(split_part(order_id, '-', 2) as bigint) as n from bronze"

PARTS["texts"] = """
  select * replace (
    case when n % 41 = 0 then '2024-13-01'
         when n % 43 = 0 then strftime(order_date, '%Y-%m-%d') || ' 10:00:00'
         else strftime(order_date, '%Y-%m-%d') end as order_date,
    case when n % 37 = 0 then 'n/a' else cast(quantity as varchar) end as quantity,
    case when n % 31 = 0 then cast(unit_price as varchar) || '56' else cast(unit_price as varchar) end as unit_price,
    case when n % 47 <> 0 then customer_id end as customer_id)
  from numbered"""

# A day reads as a date only when the text is exactly one.
PARTS["typed"] = """
  select * replace (
    case when length(order_date) = 10 then try_cast(order_date as date) end as order_date,
    try_cast(quantity as decimal(18,4)) as quantity,
    try_cast(unit_price as decimal(18,4)) as unit_price)
  from texts"""

PARTS["cleansed"] = f"""
  select * replace ({STATUS} as status, coalesce(region, 'UNKNOWN') as region,
    coalesce(sales_rep_id, 'UNASSIGNED') as sales_rep_id)
  from bronze
  where order_id is not null and order_date is not null and customer_id is not null and product_id is not null"""

PARTS["rates"] = """
  select * from (values ('USD', cast(1 as decimal(18,6))), ('EUR', cast(1.085 as decimal(18,6))),
    ('GBP', cast(1.270 as decimal(18,6))), ('CAD', cast(0.741 as decimal(18,6)))) as t(from_currency, rate_to_usd)"""


def _usd(column: str) -> str:
    return f"cast(round(cast({column} as decimal(38,4)) * coalesce(rate_to_usd, cast(1 as decimal(18,6))), 4) as decimal(18,4))"


USD = f"""{_usd('unit_price')} as unit_price_usd, {_usd('total_amount')} as total_amount_usd,
    currency as original_currency, coalesce(rate_to_usd, cast(1 as decimal(18,6))) as fx_rate_to_usd"""

HASH = """md5(coalesce(customer_id, '') || '|' || coalesce(product_id, '') || '|' || coalesce(cast(quantity as varchar), '')
    || '|' || coalesce(cast(unit_price as varchar), '') || '|' || coalesce(status, '') || '|' || coalesce(region, ''))"""


def _staged(run: str, where: str) -> str:
    return f"""
  select order_id, order_date, cast(year(order_date) as int) as order_year, cast(month(order_date) as int) as order_month,
    customer_id, product_id, quantity, {USD}, status, region, sales_rep_id, {run} as _valid_from,
    cast(null as timestamp) as _valid_to, true as _is_current, {run} as _updated_ts, {HASH} as _source_hash,
    _ingestion_ts as _delivered_ts
  from (select *, row_number() over (partition by order_id order by {NEWEST}) as place from cleansed where {where}) d
    left join rates on currency = from_currency
  where place = 1"""


PARTS["staged"] = _staged(RUN_1, "true")
PARTS["first_batch"] = _staged(RUN_1, f"_ingestion_ts < {CUT}")
PARTS["second_batch"] = _staged(RUN_2, f"_ingestion_ts >= {CUT} or region <> 'AMER'")

# The first batch is all current, so the target has no history yet.
PARTS["judged"] = """
  select t.*, coalesce(t._source_hash <> s._source_hash, false) as changed
  from first_batch t left join second_batch s on t.order_id = s.order_id"""
PARTS["inserts"] = """
  select s.* from second_batch s
  where not exists (select 1 from first_batch t where t.order_id = s.order_id
                    and coalesce(t._source_hash = s._source_hash, true))"""
PARTS["closed"] = f"""
  select * exclude (changed) replace (
    case when changed then {RUN_2} else _valid_to end as _valid_to, not changed as _is_current,
    case when changed then {RUN_2} else _updated_ts end as _updated_ts)
  from judged"""
PARTS["silver"] = "select * from closed union all select * from inserts"

RUN_EARLY, RUN_BETWEEN, RUN_AFTER = "timestamp '1997-01-01 04:00:00'", "timestamp '2003-01-02 04:00:00'", "timestamp '2003-01-01 04:00:00'"
PARTS["early_batch"] = _staged(RUN_EARLY, "_ingestion_ts < timestamp '1997-01-01'")
PARTS["between_batch"] = _staged(RUN_BETWEEN, "_ingestion_ts >= timestamp '1997-01-01' and _ingestion_ts < timestamp '1999-01-01'")
PARTS["after_batch"] = _staged(RUN_AFTER, "_ingestion_ts >= timestamp '1999-01-01'")
# What becomes of the late version: like the one before, like the one after, or a version of its own.
PARTS["late_orders"] = f"""
  select *, a_id is not null and not (e_id is not null and e_hash = a_hash) as after_version,
    case when b_id is null or (e_id is not null and e_hash = b_hash) then 'none'
         when a_id is not null and not (e_id is not null and e_hash = a_hash) and a_hash = b_hash then 'move' else 'put' end as fate,
    case when a_id is null then {RUN_BETWEEN}
         else least(greatest(b_at, case when e_id is not null then {RUN_EARLY} else b_at end),
                    case when e_id is not null and e_hash = a_hash then b_at + interval 9999 day else {RUN_AFTER} end) end as b_start
  from (select e.order_id as e_id, e._source_hash as e_hash, b.order_id as b_id, b._source_hash as b_hash, b._delivered_ts as b_at,
          a.order_id as a_id, a._source_hash as a_hash, a._delivered_ts as a_at
        from early_batch e full join between_batch b on e.order_id = b.order_id
          full join after_batch a on a.order_id = coalesce(e.order_id, b.order_id)) k"""
PARTS["late_merged"] = f"""
  select e.* replace (case when fate <> 'none' then b_start when after_version then {RUN_AFTER} end as _valid_to,
    fate = 'none' and not after_version as _is_current,
    case when fate <> 'none' then {RUN_BETWEEN} when after_version then {RUN_AFTER} else _updated_ts end as _updated_ts)
  from early_batch e join late_orders on order_id = e_id
  union all
  select e.* replace (a_at as _valid_from, {RUN_BETWEEN} as _updated_ts, a_at as _delivered_ts)
  from early_batch e join late_orders on order_id = e_id where fate = 'put' and a_id is not null and not after_version
  union all
  select b.* replace (b_start as _valid_from, case when after_version then {RUN_AFTER} else a_at end as _valid_to, a_id is null as _is_current)
  from between_batch b join late_orders on order_id = b_id where fate = 'put'
  union all
  select a.* replace (case when fate = 'move' then b_start else _valid_from end as _valid_from,
    case when fate = 'move' then {RUN_BETWEEN} else _updated_ts end as _updated_ts,
    case when fate = 'move' then b_at else _delivered_ts end as _delivered_ts)
  from after_batch a join late_orders on order_id = a_id where after_version"""

PARTS["customers"] = f"""
  select 'CUST-' || c_custkey as customer_id, c_name as customer_name,
    case when c_acctbal > 5000 then 'Enterprise' else 'Standard' end as account_type, c_mktsegment as industry,
    n_name as country, 'CITY-' || (c_custkey % 100) as city, {REGION} as region,
    'c' || c_custkey || '@mail.example' as email, cast(null as varchar) as account_manager_id,
    cast(c_acctbal as decimal(18,2)) as credit_limit, {CURRENCY} as currency, c_acctbal >= 0 as is_active
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""


def _customer_hash(table: str) -> str:
    cols = ["customer_name", "account_type", "industry", "country", "city", "region", "email", "account_manager_id",
            "credit_limit", "currency", "is_active"]
    text = " || '|' || ".join(f"coalesce(cast({c} as varchar), '')" for c in cols)
    return f"select *, md5({text}) as source_hash from {table}"


PARTS["customers_first"] = _customer_hash("customers") + " where credit_limit < 8000"
PARTS["customers_revised"] = """
  select * replace (case when industry = 'BUILDING' then 'CONSTRUCTION' else industry end as industry) from customers"""
PARTS["customers_later"] = _customer_hash("customers_revised")
PARTS["customer_rows_first"] = """
  select row_number() over (order by md5(customer_id), customer_id) as customer_sk, * from customers_first"""
PARTS["customer_new"] = """
  select * from customers_later s
  where not exists (select 1 from customers_first t where t.customer_id = s.customer_id and t.source_hash = s.source_hash)"""

PARTS["d_customer"] = """
  select row_number() over (order by md5(customer_id), customer_id) as customer_sk, * from customers"""
PARTS["d_product"] = """
  select row_number() over (order by md5(product_id), product_id) as product_sk, * from (
    select 'PROD-' || p_partkey as product_id, 'SKU-' || p_partkey as sku, p_name as product_name, p_type as category,
      p_brand as subcategory, cast(p_retailprice as decimal(18,4)) as unit_price,
      cast(round(cast(p_retailprice as decimal(18,4)) * cast(0.6 as decimal(2,1)), 4) as decimal(18,4)) as cost_price
    from part) p"""
PARTS["d_employee"] = """
  select row_number() over (order by md5(employee_id), employee_id) as employee_sk, * from (
    select 'REP-' || s_suppkey as employee_id, s_name as full_name, n_name as team
    from supplier join nation on s_nationkey = n_nationkey) e"""


def _fact(source: str, run: str, run_id: str) -> str:
    return f"""
  select order_id, customer_sk, product_sk, employee_sk as sales_rep_sk,
    cast(strftime(order_date, '%Y%m%d') as int) as date_sk, order_date, s.status, s.region, quantity, unit_price_usd,
    total_amount_usd, original_currency, fx_rate_to_usd,
    total_amount_usd - cast(round(cast(quantity as decimal(38,4)) * cost_price, 4) as decimal(18,4)) as gross_margin_usd,
    cast(round(cast(quantity as decimal(38,4)) * cost_price, 4) as decimal(18,4)) as cost_amount_usd,
    {run} as created_ts, {run} as updated_ts, '{run_id}' as pipeline_run_id
  from {source} s join d_customer c on s.customer_id = c.customer_id join d_product p on s.product_id = p.product_id
    left join d_employee e on s.sales_rep_id = e.employee_id"""


PARTS["fact_all"] = _fact("staged", RUN_1, RUN_ID)
PARTS["fact"] = "select row_number() over (order by md5(order_id), order_id) as sales_order_sk, * from fact_all"
PARTS["fact_first_rows"] = _fact("first_batch", RUN_1, "RUN-1")
PARTS["fact_first"] = """
  select row_number() over (order by md5(order_id), order_id) as sales_order_sk, * from fact_first_rows"""
PARTS["fact_second_rows"] = _fact("second_batch", RUN_2, "RUN-2")


def _average(column: str) -> str:
    """Mean rounded half up at four places, in whole numbers throughout (amounts are not negative)."""
    units = f"cast(sum({column}) * 10000 as hugeint)"
    return f"cast((2 * {units} + count(*)) // (2 * count(*)) as double) / 10000"


def _summary(fact: str, run: str, where: str = "true") -> str:
    return f"""
  select order_date, year(order_date) as order_year, month(order_date) as order_month,
    quarter(order_date) as order_quarter, coalesce(f.region, 'UNKNOWN') as region,
    coalesce(category, 'UNKNOWN') as category, status, count(*) as order_count,
    count(distinct customer_sk) as customer_count, sum(quantity) as total_quantity,
    sum(total_amount_usd) as total_revenue_usd, sum(coalesce(cost_amount_usd, 0)) as total_cost_usd,
    sum(coalesce(gross_margin_usd, 0)) as gross_margin_usd, {_average('total_amount_usd')} as avg_order_value_usd,
    {run} as refreshed_ts
  from {fact} f join d_product p on f.product_sk = p.product_sk
  where status <> 'Cancelled' and {where}
  group by order_date, coalesce(f.region, 'UNKNOWN'), coalesce(category, 'UNKNOWN'), status"""


PARTS["summary"] = _summary("fact_all", RUN_1)

# Percentage rounded half up at two places, in whole numbers: 2 * |margin| * 10^4 + revenue over 2 * revenue.
_M, _R = "cast(gross_margin_usd * 10000 as hugeint)", "cast(total_amount_usd * 10000 as hugeint)"
PARTS["overview"] = f"""
  select order_date, year(order_date) as order_year, strftime(order_date, '%Y-%m') as year_month,
    year(order_date) || '-Q' || quarter(order_date) as year_quarter, c.customer_id, customer_name, industry, country,
    account_type, p.product_id, product_name, category, subcategory, f.region, full_name as sales_rep_name,
    team as sales_team, order_id, status, quantity, unit_price_usd, total_amount_usd as revenue_usd, cost_amount_usd,
    gross_margin_usd,
    case when total_amount_usd > 0
      then cast(sign(gross_margin_usd) * ((2 * abs({_M}) * 10000 + {_R}) // (2 * {_R})) as double) / 100 end
      as gross_margin_pct,
    original_currency, fx_rate_to_usd
  from fact f join d_customer c on f.customer_sk = c.customer_sk join d_product p on f.product_sk = p.product_sk
    left join d_employee e on f.sales_rep_sk = e.employee_sk
  where status <> 'Cancelled'"""

PARTS["completed"] = """
  select s.*, c.customer_name, p.product_name, p.category
  from staged s left join customers c on s.customer_id = c.customer_id left join d_product p on s.product_id = p.product_id
  where _is_current and status = 'Completed'"""

PARTS["runs"] = """
  select case user_id % 4 when 0 then 'ingest_sales_orders' when 1 then 'ingest_crm_accounts'
      when 2 then 'transform_silver_sales' else 'transform_gold_sales_summary' end as pipeline_name,
    'RUN-' || event_id as run_id,
    case event_type when 'error' then 'FAILED' when 'view' then 'RUNNING' else 'SUCCESS' end as status,
    cast(floor(value) as bigint) as rows_processed, date_trunc('day', ts) as last_watermark, ts as run_date,
    case when event_type = 'error' then 'failed with ' || props end as error_message
  from events"""

PARTS["accounts"] = """
  select 'Account' as record_type, '/Account/' || c_custkey as record_url, 'A' || c_custkey as "Id", c_name as "Name",
    c_mktsegment as "Industry", c_acctbal as "AnnualRevenue",
    cast('2024-01-' || lpad(cast(c_custkey % 31 + 1 as varchar), 2, '0') || ' 08:30:00' as timestamp) as "LastModifiedDate"
  from customer"""


def _check(name: str, failing: str, label: str) -> str:
    n = f"coalesce(sum(case when {failing} then 1 else 0 end), 0)"
    return f"""select '{name}' as check_name, {n} = 0 as passed, {n} as failed_rows, count(*) as total_rows,
      {n} || ' {label.replace("'", "''")}' as detail from """


def _unique(name: str, table: str, key: str) -> str:
    return f"""
  select '{name}' as check_name, coalesce(sum(case when k > 1 then k end), 0) = 0 as passed,
    coalesce(sum(case when k > 1 then k end), 0) as failed_rows, sum(k) as total_rows,
    coalesce(sum(case when k > 1 then k end), 0) || ' rows share their key' as detail
  from (select count(*) as k from {table} group by {key}) g"""


TIERS = """
  select case when ingestion_date >= date '2002-12-01' - 720 then 'hot'
              when ingestion_date >= date '1997-12-01' then 'archive' else 'expired' end as tier, ingestion_date
  from bronze"""

BODIES: dict[str, str] = {
    "status_standardise": f"select order_id, {STATUS} as status from bronze",
    "status_strict": """select order_id, case when status in ('C', 'COMP', 'COMPLETED') then 'Completed'
        when status in ('P', 'PEND', 'PENDING') then 'Pending' when status in ('X', 'CANC', 'CANCELLED') then 'Cancelled'
        else 'Unknown' end as status from bronze""",
    "typed_cleanse": """select order_id, order_date, year(order_date) as order_year, month(order_date) as order_month,
        quantity, unit_price, total_amount from typed""",
    "default_fill": """select order_id, coalesce(region, 'UNKNOWN') as region,
        coalesce(sales_rep_id, 'UNASSIGNED') as sales_rep_id from bronze""",
    "required_not_null": f"""select order_id, order_date, customer_id, product_id, quantity, {STATUS} as status,
        coalesce(region, 'UNKNOWN') as region, coalesce(sales_rep_id, 'UNASSIGNED') as sales_rep_id from typed
        where order_id is not null and order_date is not null and customer_id is not null and product_id is not null""",
    "date_parts": """select order_id, year(order_date) as order_year, month(order_date) as order_month,
        quarter(order_date) as order_quarter, strftime(order_date, '%Y-%m') as year_month,
        year(order_date) || '-Q' || quarter(order_date) as year_quarter,
        cast(strftime(order_date, '%Y%m%d') as int) as date_sk from bronze""",
    "row_hash": f"select order_id, {HASH} as _source_hash from cleansed",
    "fx_convert": f"select order_id, {USD} from bronze left join rates on currency = from_currency",
    "fx_missing_rate": """select currency as original_currency, count(*) as order_count,
        sum(case when rate_to_usd is null then 1 else 0 end) as missing_fx_rate
        from bronze left join rates on currency = from_currency group by currency""",
    "dedup_latest": f"""select * from (select *, row_number() over (partition by order_id order by {NEWEST}) as place
        from bronze) d where place = 1""",
    "incremental_scan_day": "select * from bronze where ingestion_date = date '1998-06-02'",
    "watermark_window": f"""select l_orderkey, l_linenumber, l_shipdate, {RUN_1} as _ingestion_ts,
        '{RUN_ID}' as _source_file, false as _is_deleted from lineitem
        where l_shipdate > timestamp '1996-01-01' and l_shipdate <= timestamp '1997-01-01'""",
    "max_watermark_value": "select cast(max(l_shipdate) as varchar) as max_watermark from lineitem",
    "scd2_stage": "select * from first_batch",
    "scd2_merge": "select * from silver",
    "feed_replay": "select * from silver",
    "scd2_merge_late": "select * from late_merged",
    "scd2_change_feed": f"""
        select *, 'insert' as _change_type, {RUN_2} as _commit_ts from inserts
        union all
        select * exclude (changed), 'update_preimage', {RUN_2} from judged where changed
        union all
        select *, 'update_postimage', {RUN_2} from closed where not _is_current""",
    "scd2_effective_changes": "select * from inserts",
    "scd2_as_of": """select * from silver where _valid_from <= timestamp '2002-01-01 12:00:00'
        and (_valid_to is null or timestamp '2002-01-01 12:00:00' < _valid_to)""",
    "scd2_as_of_join": """select a.order_id, a._ingestion_ts, a.seen_at, v._source_hash, v._valid_from
        from (select order_id, _ingestion_ts, case when quantity > 25 then timestamp '2002-01-01 12:00:00'
              else timestamp '2002-01-03 00:00:00' end as seen_at from bronze) a
        left join silver v on a.order_id = v.order_id and v._valid_from <= a.seen_at
          and (v._valid_to is null or a.seen_at < v._valid_to)""",
    "scd2_current_count": "select count(*) as active_rows from silver where _is_current",
    "dim_customer": f"""
        select t.*, {RUN_1} as valid_from, case when n.customer_id is null then cast(null as timestamp) else {RUN_2} end
            as valid_to, n.customer_id is null as is_current, {RUN_1} as created_ts,
          case when n.customer_id is null then {RUN_1} else {RUN_2} end as updated_ts
        from customer_rows_first t left join customer_new n on t.customer_id = n.customer_id
        union all
        select (select count(*) from customers_first) + row_number() over (order by md5(customer_id), customer_id), *,
          {RUN_2}, cast(null as timestamp), true, {RUN_2}, {RUN_2}
        from customer_new""",
    "dim_product": f"""select *, {RUN_1} as valid_from, cast(null as timestamp) as valid_to, true as is_current, {RUN_1} as created_ts,
          {RUN_1} as updated_ts, md5(coalesce(sku, '') || '|' || coalesce(product_name, '') || '|' || coalesce(category, '') || '|'
            || coalesce(subcategory, '') || '|' || coalesce(cast(unit_price as varchar), '') || '|'
            || coalesce(cast(cost_price as varchar), '') || '|' || currency || '|' || uom || '||' || 'true') as source_hash
        from (select *, 'USD' as currency, 'EA' as uom, cast(null as varchar) as supplier_id, true as is_active from d_product) p""",
    "dim_employee": f"""select *, {RUN_1} as valid_from, cast(null as timestamp) as valid_to, true as is_current, {RUN_1} as created_ts,
          {RUN_1} as updated_ts, md5(coalesce(full_name, '') || '|' || coalesce(team, '')) as source_hash from d_employee""",
    "dim_date": """select cast(strftime(day, '%Y%m%d') as int) as date_sk, day as date, year(day) as year,
        quarter(day) as quarter, month(day) as month, strftime(day, '%Y-%m') as year_month
        from (select cast(unnest(generate_series(min(order_date), max(order_date), interval 1 day)) as date) as day
              from bronze) d""",
    "silver_enriched": """select s.*, c.customer_name, p.product_name, p.category from staged s
        left join customers c on s.customer_id = c.customer_id left join d_product p on s.product_id = p.product_id""",
    "fact_sales_orders": "select * from fact",
    "fact_unresolved": """select s.*, 'customer_id' as unresolved from staged s
        where not exists (select 1 from customers_first c where c.customer_id = s.customer_id)""",
    "fact_upsert": """
        select * from fact_first where order_id not in (select order_id from fact_second_rows)
        union all
        select o.sales_order_sk, n.* replace (o.created_ts as created_ts)
        from fact_second_rows n join fact_first o on n.order_id = o.order_id
        union all
        select (select count(*) from fact_first) + row_number() over (order by md5(order_id), order_id), *
        from fact_second_rows where order_id not in (select order_id from fact_first)""",
    "daily_summary_full": "select * from summary",
    "daily_summary_replace_date": f"""
        select * from ({_summary('fact_first', RUN_1)}) old where order_date <> date '1998-03-02'
        union all
        select * from ({_summary('fact_all', RUN_2, "order_date = date '1998-03-02'")}) new""",
    "daily_summary_keys": """select row_number() over (order by
          md5(cast(order_date as varchar) || '|' || region || '|' || category || '|' || status),
          order_date, region, category, status) as summary_sk, * from summary""",
    "sales_overview": "select * from overview",
    "sales_overview_secured": f"""select * from overview where region in (
        select coalesce({REGION}, 'UNKNOWN') from nation join region on n_regionkey = r_regionkey
        where n_name = 'NATION_3')""",
    "completed_orders": "select * from completed",
    "monthly_revenue": """select strftime(order_date, '%Y-%m') as year_month, sum(total_amount_usd) as revenue_usd
        from completed group by 1""",
    "top_customers": """select customer_name, sum(total_amount_usd) as revenue_usd from completed
        group by customer_name order by revenue_usd desc, customer_name limit 10""",
    "region_category_matrix": """select region, category, sum(total_amount_usd) as revenue_usd from completed
        where region is not null and category is not null group by region, category""",
    "sales_totals": f"""select sum(total_amount_usd) as total_revenue_usd, count(*) as order_count,
        count(distinct customer_id) as customer_count, count(distinct product_id) as product_count,
        {_average('total_amount_usd')} as avg_order_value_usd, min(order_date) as first_date,
        max(order_date) as last_date from completed""",
    "dq_core_checks": " union all ".join(
        _check(*c) + "staged"
        for c in [
            ("no_null_order_ids", "order_id is null", "rows with null order_id"),
            ("positive_quantity", "quantity <= 0", "rows with quantity <= 0"),
            ("known_status", "status = 'Unknown'", "rows with 'Unknown' status"),
            ("non_negative_revenue", "total_amount_usd < 0", "rows with total_amount_usd < 0"),
        ]
    )
    + """ union all select 'non_empty', count(*) > 0, case when count(*) = 0 then 1 else 0 end, count(*),
        'Total rows: ' || count(*) from staged""",
    "dq_contract_checks": " union all ".join(
        _check(*c) + "typed"
        for c in [
            ("order_id_not_null", "order_id is null", "rows with null order_id"),
            ("ingestion_date_not_null", "ingestion_date is null", "rows with null ingestion_date"),
            ("quantity_rule", "not coalesce(quantity > 0, true)", "rows against quantity > 0"),
            ("total_amount_rule", "not coalesce(total_amount >= 0, true)", "rows against total_amount >= 0"),
        ]
    ),
    "dq_duplicate_keys": """select order_id, ingestion_date, count(*) as row_count from bronze
        group by order_id, ingestion_date having count(*) > 1""",
    "dq_uniqueness": _unique("order_id_ingestion_date_unique", "bronze", "order_id, ingestion_date")
    + " union all "
    + _unique("order_id_unique", "(select * from silver where _is_current)", "order_id"),
    "dq_dictionary": _check(
        "region_domain", "region not in ('EMEA', 'AMER', 'APAC', 'UNKNOWN')", "rows outside the regions"
    )
    + "staged union all "
    + _check(
        "amount_is_quantity_times_price",
        """abs(total_amount_usd - cast(quantity as decimal(30,4)) * cast(unit_price_usd as decimal(38,4)))
           > cast(0.00005 as decimal(6,5)) * cast(quantity as decimal(30,4)) + cast(0.00005 as decimal(6,5))""",
        "rows whose amount is not quantity x price",
    )
    + "staged",
    "strict_conform": """
        select order_id, case when length(order_date) = 10 then try_cast(order_date as date) end as order_date,
          try_cast(quantity as decimal(18,4)) as quantity, try_cast(unit_price as decimal(18,4)) as unit_price,
          concat_ws(',', case when length(order_id) > 9 then 'order_id' end,
            case when n % 41 = 0 or n % 43 = 0 then 'order_date' end,
            case when n % 37 = 0 then 'quantity' end, case when n % 31 = 0 then 'unit_price' end) as conform_errors
        from texts""",
    "control_last_watermark": """select pipeline_name, max(last_watermark) as watermark from runs
        where status = 'SUCCESS' group by pipeline_name""",
    "control_ready": """select count(*) as success_count from runs where pipeline_name = 'transform_silver_sales'
        and cast(run_date as date) = date '2024-01-15' and status = 'SUCCESS'""",
    "control_recent_failures": """select * from runs where status = 'FAILED' order by run_date desc, run_id limit 20""",
    "control_failures_since": """select * from runs where status = 'FAILED'
        and run_date > timestamp '2024-01-19 12:00:00'""",
    "control_repair": """select * replace (case when hit then 'SUCCESS' else status end as status,
          case when hit then timestamp '2024-01-22 00:00:00' else last_watermark end as last_watermark,
          case when hit then null else error_message end as error_message)
        from (select *, pipeline_name = 'ingest_sales_orders' and status = 'FAILED'
                and cast(run_date as date) = date '2024-01-23' as hit from runs) r""",
    "retention_split": f"select tier, ingestion_date, count(*) as row_count from ({TIERS}) t group by tier, ingestion_date",
    "job_silver_refresh": "select * from staged",
    "job_gold_refresh": "select * from fact",
    "job_run_log": f"""select 'transform_silver_sales' as pipeline_name, 'SUCCESS' as status, (select count(*) from staged) as rows_processed,
          {RUN_1} as run_date
        union all select 'transform_gold_sales_summary', 'SUCCESS', (select count(*) from fact_all), {RUN_1}""",
    "archive_ledger": """select cast(date_trunc('month', ingestion_date) as date) as ingestion_date, count(*) as row_count from bronze
        where cast(date_trunc('month', ingestion_date) as date) >= date '1997-12-01'
          and cast(date_trunc('month', ingestion_date) as date) < date '2002-12-01' - 720 group by 1""",
    "cluster_rewrite_orders": """select *, 'BATCH-' || strftime(_ingestion_ts, '%Y%m') as _source_file, false as _is_deleted from bronze""",
    "catalog_explode": """
        select 'PROD-' || p_partkey as product_id, p_name as product_name, p_type as category, p_brand as subcategory,
          p_retailprice as unit_price, p_size as min_order_qty, date '2024-01-10' as last_modified from part
        union all
        select 'PROD-' || p_partkey || '-R', p_name, p_type, p_brand, p_retailprice / 2, p_size, date '2024-01-10'
        from part""",
    "csv_quarantine": """
        select order_id, cast(case when n % 37 <> 0 then cast(quantity as int) end as bigint) as quantity,
          case when n % 37 <> 0 then unit_price end as unit_price, case when n % 37 <> 0 then status end as status,
          case when n % 37 = 0 then 'unreadable record' end as reason from numbered""",
    "catalog_quarantine": """
        select 'PROD-' || p_partkey || suffix as product_id, case when p_partkey % 17 <> 0 then p_retailprice / part_of end as unit_price,
          case when p_partkey % 17 = 0 then 'unreadable record' end as reason
        from part, (values ('', 1), ('-R', 2)) as t(suffix, part_of) where p_partkey % 17 <> 0 or suffix = ''""",
    "crm_page_sets": """
        select 'accounts ' || response as query, count(*) as pages, sum(n) as records, max(total) as announced,
          count(*) filter (where page = last) as last_pages, sum(n) = max(total) and count(*) filter (where page = last) = 1 as complete
        from (select *, sum(n) over (partition by response) as total, max(page) over (partition by response) as last
              from (select c_custkey // 10 as response, (c_custkey % 10) // 4 as page, count(*) as n from customer group by all) a) p
        where page < last or response % 13 <> 0 group by response""",
    "crm_merge_windows": """select * from accounts
        where "LastModifiedDate" > timestamp '2024-01-21 12:00:00' and "LastModifiedDate" <= timestamp '2024-01-24 12:00:00'""",
    "bronze_landing": """select order_id, ingestion_date, quantity, 'BATCH-' || strftime(_ingestion_ts, '%Y%m') as _source_file from bronze""",
    "crm_explode": "select * from accounts",
    "crm_recent": """select * from accounts where "LastModifiedDate" > timestamp '2024-01-17 12:00:00'""",
}

BODIES["dq_observed"] = BODIES["dq_contract_checks"]


def _needed(text: str, found: list[str]) -> list[str]:
    words = set(re.findall(r"\w+", text))
    for name, body in PARTS.items():
        if name in words and name not in found:
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


def oracle(name: str) -> str:
    body = BODIES[name]
    parts = _needed(body, [])
    ctes = ",\n".join(f"{p} as ({PARTS[p]})" for p in parts)
    picked = [c.split(":") for c in OUTPUT[name].split()]
    cols = ", ".join(f'cast("{n}" as {SQL_TYPES[k]}) as "{n}"' for n, k in picked)
    return (f"with {ctes}\n" if ctes else "") + f"select {cols} from (\n{body}\n) as result"


ORACLES = {name: oracle(name) for name in BODIES}
