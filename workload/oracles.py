"""DuckDB SQL that computes the result of each query from the same tables."""

from __future__ import annotations

from itertools import product

from workload.inputs import duck
from workload.queries import SAMPLE, SEED

ORACLES: dict[str, str] = {}

# What counts as a number, and the code points of white space, written out once more here.
NUMBER = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*$"
BLANKS = [9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233, 8239, 8287, 12288]


def with_input(name: str, sql: str, *more: str) -> str:
    """Prefix a query by one derived input, under its lower-case name, and further CTEs."""
    return f"with {', '.join([f'{name.lower()} as ({duck(name)})', *more])} {sql}"


def union(parts) -> str:
    return " union all ".join(parts)


def marks_off(x: str) -> str:
    return f"regexp_replace({x}, '[$,₹]', '', 'g')"


def num(x: str) -> str:
    return f"case when regexp_matches({x}, '{NUMBER}') then try_cast({x} as double) end"


def amount(x: str) -> str:
    return f"try_cast(trim({x}) as double)"


def bin_of(value: str, low: str, high: str, bins: int) -> str:
    return (
        f"cast(case when {value} <= {low} then 0 when {value} >= {high} then {bins - 1} "
        f"else least(floor(({value} - {low}) / (({high} - {low}) / {bins})), {bins - 1}) end as integer)"
    )


def text(value: str) -> str:
    return f"cast({value} as varchar)"


# Sources and sinks ---------------------------------------------------------------

CUSTOMER_TEXT = """select {0} from customer"""
_customer = ["c_custkey", "c_name", "c_nationkey", "cast(c_acctbal as decimal(18,2))", "c_mktsegment"]
_customer_names = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]

ORDERS_DAY = (
    "select o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "cast(o_orderdate as date) as o_orderdate, o_orderpriority"
)

ORACLES["scan_parquet"] = f"{ORDERS_DAY} from orders"
ORACLES["scan_csv_strings"] = CUSTOMER_TEXT.format(
    ", ".join(f"cast({x} as varchar) as {n}" for x, n in zip(_customer, _customer_names))
)
ORACLES["scan_csv_typed"] = """
select o_orderkey,
  case when o_orderkey % 9 = 0 or o_orderkey % 10 = 0 then null else o_totalprice end as price,
  case when o_orderkey % 11 = 0 then null else o_orderpriority end as priority,
  o_orderkey % 2 = 0 as even, cast(cast(o_orderdate as date) as varchar) as day,
  cast(null as double) as nothing
from orders
"""
ORACLES["scan_jsonl"] = (
    "select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey, c_acctbal, c_mktsegment"
    " from customer"
)
ORACLES["scan_json_array"] = ORACLES["scan_json_columns"] = ORACLES["scan_jsonl"]
ORACLES["scan_other_format"] = ORACLES["scan_parquet"]
ORACLES["partition_rows"] = "select count(*)::bigint as n_rows from lineitem"
ORACLES["scan_dispatch"] = union(
    f"select '{suffix}' as suffix, c_custkey, cast(c_nationkey as bigint) as c_nationkey, c_name, c_mktsegment,"
    " cast(cast(c_acctbal as decimal(18,2)) as double) as c_acctbal from customer"
    for suffix in ("parquet", "csv", "json", "jsonl")
)
ORACLES["csv_rejects"] = (
    "select case when (o_orderkey % 5 = 0) = (o_orderkey % 7 = 0) then 'good'"
    " when o_orderkey % 5 = 0 then 'too few cells' else 'too many cells' end as reason,"
    " count(*) as n_rows, cast(sum(o_orderkey) as bigint) as key_sum,"
    " cast(sum(case when (o_orderkey % 5 = 0) = (o_orderkey % 7 = 0) then 1 when o_orderkey % 5 = 0 then 2 else 3 end)"
    " as bigint) as n_last from orders group by 1"
)
ORACLES["scan_guards"] = (
    "select * from (values ('missing', 'MissingPathError'), ('unknown', 'UnsupportedFormatError'),"
    " ('broken', 'UnreadableTableError'), ('nothing left', 'EmptyResultError')) t(attempt, outcome)"
    " union all select 'readable', cast(count(*) as varchar) from nation"
)
ORACLES["price_columns_missing"] = (
    "select 'prices' as input, count(*) as n_rows, '' as missing from orders union all"
    " select 'orders', count(*), 'actual_price,average_rating,selling_price' from orders union all"
    " select 'partly', count(*), 'selling_price' from orders"
)
_kept = (
    "select c_custkey, c_name, cast(c_nationkey as bigint) as c_nationkey,"
    " cast(cast(c_acctbal as decimal(18,2)) as double) as c_acctbal, c_mktsegment from customer"
)
ORACLES["kept_table"] = _kept
ORACLES["kept_table_changed"] = f"{_kept} where c_custkey % 3 = 0"

# Price cleaning and sampling -----------------------------------------------------

CLEAN_PRICES = f"""
select * from (
  select o_orderkey, {amount(marks_off('actual_price'))} as actual_price,
    {amount(marks_off('selling_price'))} as selling_price,
    {amount('average_rating')} as average_rating, o_orderpriority
  from prices) t
where actual_price is not null and selling_price is not null and average_rating is not null
"""
SAMPLED = f" order by md5(concat('{SEED}:', o_orderkey)), o_orderkey limit {SAMPLE}"

ORACLES["price_clean"] = with_input("PRICES", CLEAN_PRICES)
ORACLES["price_clean_stream"] = ORACLES["price_clean"]
ORACLES["price_clean_passthrough"] = "select * from events"
ORACLES["clean_sample"] = with_input("PRICES", CLEAN_PRICES + SAMPLED)
ORACLES["sink_csv_roundtrip"] = ORACLES["clean_sample"]
ORACLES["process_file"] = ORACLES["clean_sample"]
ORACLES["sample_repeating_key"] = f"""
with counted as (
  select l_suppkey, l_returnflag, l_linenumber, count(*) as copies,
    md5('{SEED}:' || l_suppkey || ':{{"l_suppkey":' || l_suppkey || ',"l_returnflag":"' || l_returnflag
        || '","l_linenumber":' || l_linenumber || '}}') as h
  from lineitem group by 1, 2, 3),
running as (select *, sum(copies) over (order by h) - copies as before from counted)
select l_suppkey, l_returnflag, l_linenumber
from running, range(1, {SAMPLE} + 1) g(i) where i <= copies and before + i <= {SAMPLE}
"""
ORACLES["csv_roundtrip_text"] = """
select md5(doc_id::varchar) as doc_id, md5(text) as text, md5(lang) as lang, md5(source) as source,
  md5(n_chars::varchar) as n_chars from documents
"""
ORACLES["scan_csv_long_ids"] = with_input(
    "LONG_IDS", "select long_id::bigint as long_id, huge_id, short_id::bigint as short_id from long_ids"
)
ORACLES["autoclean_long_ids"] = ORACLES["scan_csv_long_ids"]
ORACLES["date_profile_slashed"] = """
select 0 as seq, 'stamp' as "column", count(*) as n_rows, 'slashed_time' as layout,
  count(*) filter (o_orderkey % 8 <> 0) as n_dates,
  round(count(*) filter (o_orderkey % 8 <> 0) / count(*)::double, 4) as date_share,
  count(*) filter (o_orderkey % 8 <> 0) / count(*)::double > 0.7 as becomes_date
from orders
"""
ORACLES["date_profile_dayfirst"] = union(
    f"select {place} as seq, '{name}' as \"column\", count(*) as n_rows, '{layout}' as layout,"
    f" count(*) filter ({met}) as n_dates, round(count(*) filter ({met}) / count(*)::double, 4) as date_share,"
    " true as becomes_date from orders"
    for place, (name, layout, met) in enumerate(
        [
            ("slashed", "day_slashed", "o_orderkey % 10 <> 0"), ("slashed_time", "day_slashed_time", "o_orderkey % 10 <> 1"),
            ("dotted", "dotted", "o_orderkey % 10 <> 2"), ("named", "day_full_month", "o_orderkey % 10 <> 3"),
            ("zoned", "iso_offset", "true"),
        ]
    )
)
ORACLES["null_counts_nan"] = with_input(
    "MEASURES",
    union(
        [
            f"select {seq} as seq, '{c}' as \"column\", count(*) - count({c}) as n_null from measures"
            for seq, c in enumerate(("quantity", "extendedprice", "discount", "tax", "constant_col"))
        ]
        + ["select -1, 'all columns', count(*) * 2 - count(quantity) - count(extendedprice) from measures"]
    ),
)
ORACLES["sample_exact"] = f"{ORDERS_DAY} from orders {SAMPLED}"
ORACLES["sample_fraction"] = (
    f"select count(*) as n_rows, round(least(1.0::double, {SAMPLE * 1.2}::double / count(*)), 12)"
    " as fraction from orders"
)
ORACLES["sample_bernoulli"] = (
    f"{ORDERS_DAY} from orders where ('0x' || substr(md5('{SEED}:' || o_orderkey), 1, 13))::bigint"
    f" < (select round(least(1.0::double, {SAMPLE * 1.2}::double / count(*)) * {16**13}) from orders)"
)
ORACLES["preview"] = "select * from customer order by c_custkey limit 5"

# Scalar functions ----------------------------------------------------------------

_padded = "concat(chr(9), chr(160), chr(8195), ' ', text, ' ', chr(12288), chr(10))"
_blanks = " || ".join(f"chr({code})" for code in BLANKS)
ORACLES["trim_text_whole"] = (
    f"select doc_id, cast(length(t) as integer) as n_chars, md5(t) as digest"
    f" from (select doc_id, trim({_padded}, {_blanks}) as t from documents) d"
)
ORACLES["to_numeric_coerce"] = with_input(
    "MIXED",
    "select o_orderkey, "
    + ", ".join(f"{num(marks_off(c))} as {c}" for c in ("amount_text", "code_text", "half_text"))
    + " from mixed",
)
ORACLES["date_parse"] = (
    "select o_orderkey, "
    + ", ".join(
        f"case when o_orderkey % 8 <> 0 then cast(o_orderdate as date) end as {layout}"
        for layout in ("iso_date", "iso_timestamp", "slashed", "month_name", "compact", "slashed_time", "year_first",
                       "day_month", "full_month", "day_slashed", "day_slashed_time", "dotted", "plain_month",
                       "day_full_month", "day_month_name")
    )
    + ", cast(cast(o_orderdate as date) as timestamp) + interval '23 hours 30 minutes 5 seconds'"
    + " - to_minutes(case o_orderkey % 4 when 0 then 0 when 1 then 120 when 2 then -330 else 60 end) as iso_offset"
    + " from orders"
)

# Profiles ------------------------------------------------------------------------

MIXED_COLUMNS = [
    "o_orderkey", "status", "priority", "amount_text", "code_text", "half_text", "balance",
    "order_date_text",
]
MIXED_TEXT = [name for name in MIXED_COLUMNS if name not in ("o_orderkey", "balance")]


def parsed_dates(column: str) -> str:
    return f"count(case when regexp_matches({column}, '^\\d{{4}}-\\d{{1,2}}-\\d{{1,2}}$') then try_cast({column} as date) end)"


ORACLES["dataset_shape"] = "select count(*) as n_rows, 11 as n_columns from lineitem"
ORACLES["null_counts"] = with_input(
    "MIXED",
    union(
        f"select {seq} as seq, '{c}' as column, count(*) - count({c}) as n_null from mixed"
        for seq, c in enumerate(MIXED_COLUMNS)
    ),
)
ORACLES["missing_cells"] = with_input(
    "MIXED",
    "select "
    + " + ".join(f"(count(*) - count({c}))" for c in MIXED_COLUMNS)
    + " as missing_cells from mixed",
)
ORACLES["text_profile"] = with_input(
    "MIXED",
    "select seq, \"column\", n_rows, n_null, n_trimmed, has_marks, n_numeric,"
    " round(n_numeric / n_rows, 4) as numeric_share, n_numeric / n_rows > 0.5 as becomes_numeric,"
    " n_whole, cast(0 as bigint) as n_long"
    " from ("
    + union(
        f"select {seq} as seq, '{c}' as column, count(*) as n_rows, count(*) - count({c}) as n_null,"
        f" count(case when trim({c}) <> {c} then 1 end) as n_trimmed,"
        f" coalesce(bool_or(regexp_matches({c}, '[$,₹]')), false) as has_marks,"
        f" count({num(marks_off(f'trim({c})'))}) as n_numeric,"
        f" count(case when regexp_full_match({marks_off(f'trim({c})')}, '[+-]?[0-9]+') then 1 end) as n_whole from mixed"
        for seq, c in enumerate(MIXED_TEXT)
    )
    + ") t",
)
ORACLES["date_profile"] = with_input(
    "MIXED",
    "select seq, \"column\", n_rows, case when n_dates > 0 then 'iso_date' end as layout, n_dates,"
    " round(n_dates / n_rows, 4) as date_share, n_dates / n_rows > 0.7 as becomes_date from ("
    + union(
        f"select {seq} as seq, '{c}' as column, count(*) as n_rows, {parsed_dates(c)} as n_dates from mixed"
        for seq, c in enumerate(MIXED_TEXT)
    )
    + ") t",
)
ORACLES["column_roles"] = with_input(
    "MIXED",
    union(
        f"select {seq} as seq, '{c}' as column, '{kind}' as data_type, 'numeric' as role"
        if kind != "string"
        else f"select {seq} as seq, '{c}' as column, 'string' as data_type,"
        f" case when count({num(marks_off(f'trim({c})'))}) / count(*) > 0.5 then 'numeric'"
        f" when {parsed_dates(c)} / count(*) > 0.7 then 'date' else 'categorical' end as role from mixed"
        for seq, (c, kind) in enumerate(
            (c, {"o_orderkey": "bigint", "balance": "double"}.get(c, "string"))
            for c in MIXED_COLUMNS
        )
    ),
)
ORACLES["distinct_counts"] = union(
    f"select '{c}' as column, count(distinct {c}) as n_distinct from part"
    for c in ("p_name", "p_brand", "p_type")
)
ORACLES["value_counts"] = (
    "select event_type as value, count(*) as n from events where event_type is not null"
    " group by event_type order by n desc, value"
)
ORACLES["mode_per_column"] = with_input(
    "MIXED",
    union(
        f"select * from (select '{c}' as column, {c} as value, count(*) as n from mixed"
        f" where {c} is not null group by {c} order by n desc, value limit 1) t{seq}"
        for seq, c in enumerate(MIXED_TEXT)
    ),
)
_lineitem_numeric = [
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax",
]
ORACLES["median_per_column"] = union(
    f"select '{c}' as column, round(median(cast({c} as double)), 4) as median from lineitem"
    for c in _lineitem_numeric
)
ORACLES["median_narrowed"] = ORACLES["median_per_column"]

# Cleaning ------------------------------------------------------------------------


def mode(column: str, source: str = "mixed") -> str:
    return (
        f"(select {column} from {source} where {column} is not null group by {column}"
        f" order by count(*) desc, {column} limit 1)"
    )


def typed(strip_all: bool = False) -> str:
    code = marks_off("trim(code_text)") if strip_all else "trim(code_text)"
    return (
        "typed as (select o_orderkey, trim(status) as status, trim(priority) as priority,"
        f" {num(marks_off('trim(amount_text)'))} as amount_text, {code} as code_text,"
        " trim(half_text) as half_text, balance, trim(order_date_text) as order_date_text from mixed)"
    )


CLEANED = f"""cleaned as (
select o_orderkey, coalesce(status, {mode('status', 'typed')}) as status,
  coalesce(priority, {mode('priority', 'typed')}) as priority,
  coalesce(amount_text, (select median(amount_text) from typed)) as amount_text,
  code_text, half_text, coalesce(balance, (select median(balance) from typed)) as balance,
  order_date_text
from typed)"""

ORACLES["impute_median"] = with_input(
    "MIXED",
    "select * replace (coalesce(balance, (select median(balance) from mixed)) as balance) from mixed",
)
ORACLES["impute_mode"] = with_input(
    "MIXED",
    f"select * replace (coalesce(status, {mode('status')}) as status,"
    f" coalesce(priority, {mode('priority')}) as priority) from mixed",
)
ORACLES["impute_mode_unique"] = (
    "with gaps as (select doc_id, case when doc_id % 10 <> 0 then text end as text from documents)"
    f" select doc_id, md5(coalesce(text, {mode('text', 'gaps')})) as digest from gaps"
)
ORACLES["mode_long_text"] = union(
    f"(select '{c}' as \"column\", md5(cast({c} as varchar)) as digest, count(*) as n from documents where {c} is not null"
    f" group by {c} order by n desc, cast({c} as varchar) limit 1)"
    for c in ("text", "doc_id", "lang", "source")
)
ORACLES["autoclean_text"] = with_input("MIXED", "select * from typed", typed())
ORACLES["autoclean_text_strip_all"] = with_input("MIXED", "select * from typed", typed(True))
ORACLES["auto_cleaned"] = with_input("MIXED", "select * from cleaned", typed(), CLEANED)
ORACLES["cleaning_report"] = with_input(
    "MIXED",
    union(
        [
            "select 0 as seq, 'trimmed' as action, 'status' as column, count(status) as n_changed,"
            " cast(null as varchar) as fill_value from typed",
            "select 1, 'converted', 'amount_text', count(amount_text), null from typed",
            *[
                f"select {seq}, 'filled_median', '{c}', count(*) - count({c}),"
                f" format('{{:,.3f}}', median({c})) from typed"
                for seq, c in ((2, "amount_text"), (3, "balance"))
            ],
            *[
                f"select {seq}, 'filled_mode', '{c}', count(*) - count({c}), {mode(c, 'typed')} from typed"
                for seq, c in ((4, "status"), (5, "priority"))
            ],
        ]
    ),
    typed(),
)

# Charts --------------------------------------------------------------------------


def kpis(columns: list[str], source: str) -> str:
    return union(
        f"select {seq} as seq, '{c}' as column, round(coalesce(sum(cast({c} as double)), 0), 2) as total,"
        f" format('{{:,.2f}}', coalesce(sum(cast({c} as double)), 0)) as display from {source}"
        for seq, c in enumerate(columns)
    )


def mean_per(grain: str, date: str, measure: str, source: str, extra: str = "") -> str:
    return (
        f"select cast(date_trunc('{grain}', {date}) as date) as period, {extra}"
        f" round(avg({measure}), 4) as mean from {source} where {date} is not null group by 1 order by 1"
    )


def top_n(column: str, source: str, n: int) -> str:
    """Ranked frequencies folded into the first n and one remainder row."""
    return (
        "select case when k > {n} then 'Other' else value end as value, cast(sum(n) as bigint) as n,"
        " k > {n} as is_other from (select *, row_number() over (order by n desc, value) as k from"
        " (select {c} as value, count(*) as n from {s} where {c} is not null group by {c}) f) r"
        " group by case when k > {n} then 'Other' else value end, k > {n}"
    ).format(n=n, c=column, s=source)


def shares(column: str, source: str, n: int, digits: int = 4) -> str:
    return (
        f"select value, n, is_other, round(n / sum(n) over (), {digits}) as share"
        f" from ({top_n(column, source, n)}) s"
    )


def bounds(source: str, **columns: str) -> str:
    ends = ", ".join(
        f"min(cast({c} as double)) as {axis}0, max(cast({c} as double)) as {axis}1"
        for axis, c in columns.items()
    )
    return f"(select {ends} from {source}) bounds"


def hist(column: str, source: str, bins: int) -> str:
    return (
        f"select bin, round(any_value(x0 + bin * ((x1 - x0) / {bins})), 4) as bin_start,"
        f" round(any_value(x0 + (bin + 1) * ((x1 - x0) / {bins})), 4) as bin_end, count(*) as n from"
        f" (select {bin_of('v', 'x0', 'x1', bins)} as bin, x0, x1 from"
        f" (select cast({column} as double) as v from {source} where {column} is not null) d,"
        f" {bounds(source, x=column)}) t group by bin"
    )


def grid(x: str, y: str, colour: str | None, source: str, bins: int) -> str:
    c = f"{colour} as colour, " if colour else ""
    return (
        f"select x_bin, y_bin, {'colour, ' if colour else ''}count(*) as n from"
        f" (select {c}{bin_of(f'cast({x} as double)', 'x0', 'x1', bins)} as x_bin,"
        f" {bin_of(f'cast({y} as double)', 'y0', 'y1', bins)} as y_bin"
        f" from {source}, {bounds(source, x=x, y=y)} where {x} is not null and {y} is not null) t"
        f" group by x_bin, y_bin{', colour' if colour else ''}"
    )


def correlations(columns: list[str], source: str, digits: int = 6) -> str:
    def r(x: str, y: str) -> str:
        if x == y:
            return f"case when stddev_pop({x}) > 0 then 1.0::double end"
        return f"case when not isnan(corr({x}, {y})) then round(corr({x}, {y}), {digits}) end"

    return union(
        f"select '{x}' as col_x, '{y}' as col_y, {r(x, y)} as r,"
        f" count(case when {x} is not null and {y} is not null then 1 end) as n from {source}"
        for x, y in product(columns, columns)
    )


ORACLES["kpi_totals"] = kpis(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], "lineitem")
ORACLES["kpi_totals_default"] = kpis(_lineitem_numeric[:4], "lineitem")
ORACLES["date_span"] = (
    "select cast(min(l_shipdate) as date) as first, cast(max(l_shipdate) as date) as last,"
    " date_sub('day', min(l_shipdate), max(l_shipdate)) as days from lineitem"
)
ORACLES["trend_year"] = mean_per("year", "o_orderdate", "o_totalprice", "orders")
ORACLES["trend_month"] = mean_per("month", "o_orderdate", "o_totalprice", "orders")
ORACLES["trend_week"] = mean_per("week", "ts", "value", "events")
ORACLES["trend_day"] = mean_per("day", "ts", "value", "events")


def mean_per_auto(date: str, measure: str, source: str) -> str:
    grain = (
        "(select case when days > 730 then 'year' when days > 90 then 'month'"
        " when days > 7 then 'week' else 'day' end"
        f" from (select date_sub('day', min({date}), max({date})) as days from {source}) s)"
    )
    return (
        f"select cast(date_trunc({grain}, {date}) as date) as period, {grain} as grain,"
        f" round(avg({measure}), 4) as mean from {source} where {date} is not null group by 1 order by 1"
    )


ORACLES["trend_auto"] = mean_per_auto("o_orderdate", "o_totalprice", "orders")
ORACLES["trend_auto_short"] = mean_per_auto("ts", "value", "events")
ORACLES["topn_other_15"] = top_n("p_brand", "part", 15)
ORACLES["topn_other_10"] = top_n("source", "documents", 10)
ORACLES["topn_other_reserved"] = with_input("RESERVED", top_n("p_brand", "reserved", 15))
ORACLES["category_share"] = shares("o_orderpriority", "orders", 10)
ORACLES["category_share_other"] = shares("source", "documents", 10)
ORACLES["histogram"] = hist("l_extendedprice", "lineitem", 20)
ORACLES["correlation_matrix"] = with_input(
    "MEASURES",
    correlations(["quantity", "extendedprice", "discount", "tax", "constant_col"], "measures"),
)
ORACLES["correlation_far_values"] = with_input(
    "FAR_VALUES", correlations(["quantity", "extendedprice", "lifted", "tax"], "far_values")
)
_pairs = list(product([f"c{k}" for k in range(40)], repeat=2))
ORACLES["correlation_wide"] = with_input(
    "WIDE",
    "select unnest([{}]) as col_x, unnest([{}]) as col_y, unnest([{}]) as r, unnest([{}]) as n from wide".format(
        ", ".join(f"'{x}'" for x, _ in _pairs), ", ".join(f"'{y}'" for _, y in _pairs),
        ", ".join(f"round(corr({x}, {y}), 6)" for x, y in _pairs),
        ", ".join(f"regr_count({x}, {y})::bigint" for x, y in _pairs),
    ),
)
ORACLES["scatter_points"] = (
    "select l_quantity as x, l_extendedprice as y, l_returnflag as colour from lineitem"
)
ORACLES["scatter_sample"] = (
    "select o_custkey as x, o_totalprice as y, o_orderstatus as colour"
    f" from (select * from orders {SAMPLED}) t"
)
ORACLES["scatter_grid"] = grid("l_quantity", "l_extendedprice", "l_returnflag", "lineitem", 40)

# Choices and whole workflows -----------------------------------------------------


def first_between(columns: list[str], source: str, limit: int) -> str:
    tests = " ".join(
        f"when count(distinct {c}) > 1 and count(distinct {c}) < {limit} then '{c}'" for c in columns
    )
    return f"(select case {tests} else '{columns[0]}' end from {source})"


def choices(source: str, texts: list[str], numbers: list[str], **columns: str) -> str:
    order = ("date", "trend", "bar", "share", "histogram", "scatter_x", "scatter_y")
    single = [
        f"select '{chart}' as chart, 0 as place, cast({columns.get(chart, 'null')} as varchar) as column"
        for chart in order
    ]
    lists = {"kpis": numbers[:4], "correlation": numbers}
    listed = [f"select '{chart}', {k}, '{c}'" for chart, names in lists.items() for k, c in enumerate(names)]
    counted = union(f"select {k} as k, '{c}' as column, count(distinct {c}) as d from {source}" for k, c in enumerate(texts))
    few = (
        "select 'colours', cast(row_number() over (order by k) - 1 as integer), \"column\""
        f" from ({counted}) t where d > 1 and d < 20"
    )
    return union([*single, *listed, few])


_part_text = ["p_name", "p_brand", "p_type"]
ORACLES["default_columns"] = choices(
    "part", _part_text, ["p_partkey", "p_size", "p_retailprice"],
    bar=first_between(_part_text, "part", 20), share=first_between(_part_text, "part", 10),
    histogram="'p_partkey'", scatter_x="'p_partkey'", scatter_y="'p_size'",
)
_lineitem_text = ["l_returnflag", "l_linestatus"]
ORACLES["default_columns_dated"] = choices(
    "lineitem", _lineitem_text, _lineitem_numeric,
    date="'l_shipdate'", trend="'l_extendedprice'",
    share=first_between(_lineitem_text, "lineitem", 10),
    histogram="'l_orderkey'", scatter_x="'l_orderkey'", scatter_y="'l_partkey'",
)
ORACLES["colour_candidates"] = (
    "select 0 as seq, cast(null as varchar) as column union all"
    " select cast(row_number() over (order by k) as integer), \"column\" from ("
    + union(
        f"select {k} as k, '{c}' as column, count(distinct {c}) as d from part"
        for k, c in enumerate(_part_text)
    )
    + ") t where d > 1 and d < 20"
)
ORACLES["quick_facts"] = (
    "select 'l_returnflag' as column, l_returnflag as value from lineitem group by l_returnflag"
    " order by count(*) desc, l_returnflag limit 1"
)


def facts(source: str, columns: list[str], numeric: int, categorical: int) -> str:
    missing = " + ".join(f"(count(*) - count({c}))" for c in columns)
    values = {
        "n_rows": "count(*)", "n_columns": f"{len(columns)}", "missing_cells": missing,
        "numeric_columns": f"{numeric}", "categorical_columns": f"{categorical}",
    }
    return union(
        [
            *[
                f"select {seq} as seq, '{kind}' as kind, cast(null as varchar) as column,"
                f" cast({value} as varchar) as value from (select count(*) from {source}) one"
                if kind not in ("n_rows", "missing_cells")
                else f"select {seq} as seq, '{kind}' as kind, cast(null as varchar) as column,"
                f" cast({value} as varchar) as value from {source}"
                for seq, (kind, value) in enumerate(values.items())
            ],
            f"select 5, 'quick_fact', 'status', {mode('status', source)}",
        ]
    )


ORACLES["dataset_insights"] = with_input(
    "MIXED", facts("cleaned", MIXED_COLUMNS, 3, 5), typed(), CLEANED
)
ORACLES["dataset_insights_raw"] = with_input("MIXED", facts("mixed", MIXED_COLUMNS, 2, 6))


def long_form(
    chart: str, series: str, label: str, value: str, source: str, n: str = "null", low: str = "null", high: str = "null",
    colour: str = "null",
) -> str:
    return (
        f"select '{chart}' as chart, {text(series)} as series, {text(label)} as label,"
        f" round(cast({value} as double), {2 if chart == 'kpis' else 4}) as value,"
        f" cast({n} as bigint) as n, cast({low} as double) as low, cast({high} as double) as high,"
        f" {text(colour)} as colour from ({source}) {chart}_rows"
    )


def common_charts(
    source: str, numeric: list[str], share: str, colour: str | None, x: str, y: str
) -> list[str]:
    return [
        long_form("kpis", '"column"', "display", "total", kpis(numeric, source)),
        long_form("share", "is_other", "value", "share", shares(share, source, 10), "n"),
        long_form("histogram", "null", "bin", "n", hist(numeric[0], source, 20), "n", "bin_start", "bin_end"),
        long_form("correlation", "col_x", "col_y", "r", correlations(numeric, source, 4), "n"),
        long_form(
            "scatter_grid", "x_bin", "y_bin", "n", grid(x, y, colour, source, 50), "n",
            colour="colour" if colour else "null",
        ),
    ]


def dated(source: str) -> str:
    return f"dated as (select * replace (try_cast(order_date_text as date) as order_date_text) from {source})"


ORACLES["chart_data"] = with_input(
    "MIXED",
    union(
        common_charts(
            "dated", ["o_orderkey", "amount_text", "balance"], "status", "priority",
            "o_orderkey", "amount_text",
        )
        + [
            long_form(
                "trend", "'year'", "period", "mean",
                mean_per("year", "order_date_text", "amount_text", "dated"),
            )
        ]
    ),
    typed(), CLEANED, dated("cleaned"),
)
ORACLES["chart_data_raw"] = with_input(
    "MIXED",
    union(
        common_charts(
            "dated", ["o_orderkey", "balance"], "status", None, "o_orderkey", "balance"
        )
        + [
            long_form(
                "trend", "'year'", "period", "mean",
                mean_per("year", "order_date_text", "o_orderkey", "dated"),
            )
        ]
    ),
    dated("mixed"),
)
ORACLES["chart_data_bar"] = union(
    common_charts("part", ["p_partkey", "p_size", "p_retailprice"], "p_type", None, "p_partkey", "p_size")
    + [long_form("bar", "is_other", "value", "n", top_n("p_type", "part", 15), "n")]
)
