"""Registered queries. Each takes (spark, folder of the tables) and reads whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.functions.dates import LAYOUTS, parse_date
from chartloom.functions.numbers import number
from chartloom.functions.text import drop_marks, trim_text
from chartloom.operators import charts, frequency, impute, median, profile, sample
from chartloom.errors import TableReadError
from chartloom.operators.price import clean_prices, missing_expected_columns
from chartloom.plans import chart_data as chart_plans
from chartloom.plans.auto_clean import auto_clean, convert_text
from chartloom.plans import clean_sample as batch
from chartloom.plans.clean_sample import clean_and_sample
from chartloom.plans.insights import insights, quick_fact
from chartloom.plans.staging import kept
from chartloom.sources import readers, sinks
from chartloom.sources.typed_csv import read_csv_with_rejects
from chartloom.streaming.prices import write_clean_prices
from workload import files
from workload.inputs import derived, table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

SEED = 7
SAMPLE = 1000


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Doubles rounded, so that the order of a sum does not show."""
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({name: F.round(name, digits) for name in doubles}) if doubles else df


def as_day(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.col(name).cast("date") for name in names})


# Sources and sinks ---------------------------------------------------------------


@query
def scan_parquet(spark, sf_dir):
    return as_day(readers.read_parquet(spark, f"{sf_dir}/orders.parquet"), "o_orderdate")


def _customer_text(spark, sf_dir) -> DataFrame:
    return table(spark, sf_dir, "customer").withColumn(
        "c_acctbal", F.col("c_acctbal").cast("decimal(18,2)")
    )


@query
def scan_csv_strings(spark, sf_dir):
    path = sinks.write_csv(_customer_text(spark, sf_dir), files.folder(spark, sf_dir, "strings.csv"))
    return readers.read_csv_strings(spark, path)


@query
def scan_csv_typed(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.expr("case when o_orderkey % 9 = 0 then 'NA' when o_orderkey % 10 = 0 then 'null'"
               " else cast(o_totalprice as string) end").alias("price"),
        F.expr("case when o_orderkey % 11 = 0 then 'N/A' else o_orderpriority end").alias("priority"),
        F.expr("case when o_orderkey % 2 = 0 then 'True' else 'False' end").alias("even"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.lit(None).cast("string").alias("nothing"),
    )
    path = sinks.write_csv(rows, files.folder(spark, sf_dir, "typed.csv"))
    return readers.read_table(spark, path)


@query
def scan_jsonl(spark, sf_dir):
    path = files.folder(spark, sf_dir, "lines.jsonl")
    table(spark, sf_dir, "customer").write.mode("overwrite").json(path)
    return readers.read_table(spark, path)


@query
def scan_json_array(spark, sf_dir):
    documents = files.record_documents(table(spark, sf_dir, "customer"), "c_custkey")
    path = files.write_documents(documents, files.folder(spark, sf_dir, "records.json"))
    return readers.read_table(spark, path)


@query
def scan_json_columns(spark, sf_dir):
    documents = files.column_documents(table(spark, sf_dir, "customer"), "c_custkey")
    path = files.write_documents(documents, files.folder(spark, sf_dir, "columns.json"))
    return readers.read_table(spark, path)


@query
def scan_other_format(spark, sf_dir):
    path = files.folder(spark, sf_dir, "orders.orc")
    table(spark, sf_dir, "orders").write.mode("overwrite").orc(path)
    return as_day(readers.read_table(spark, path, fmt="orc"), "o_orderdate")


@query
def partition_rows(spark, sf_dir):
    return sample.partition_rows(table(spark, sf_dir, "lineitem")).agg(F.sum("n_rows").alias("n_rows"))


@query
def scan_dispatch(spark, sf_dir):
    """Every suffix, each table with all its columns."""
    rows = _customer_text(spark, sf_dir)
    parts = []
    for suffix, write in {
        "parquet": sinks.write_parquet,
        "csv": sinks.write_csv,
        "json": lambda df, path: df.write.mode("overwrite").json(path) or path,
        "jsonl": lambda df, path: df.write.mode("overwrite").json(path) or path,
    }.items():
        path = write(rows, files.folder(spark, sf_dir, f"dispatch.{suffix.upper()}"))
        parts.append(
            readers.read_table(spark, path).select(
                F.lit(suffix).alias("suffix"),
                *[F.col(c).cast("bigint").alias(c) for c in ("c_custkey", "c_nationkey")],
                "c_name",
                "c_mktsegment",
                F.col("c_acctbal").cast("double").alias("c_acctbal"),
            )
        )
    return reduce(DataFrame.unionByName, parts)


@query
def csv_rejects(spark, sf_dir):
    """Good rows and rows that are no rows of the table, told apart by why."""
    cells = F.concat_ws(
        ",",
        F.col("o_orderkey").cast("string"),
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderpriority")),
        F.when(F.col("o_orderkey") % 7 == 0, F.lit("more")),
    )
    documents = files.line_documents(table(spark, sf_dir, "orders"), "o_orderkey", cells, "key,status,priority")
    path = files.write_documents(documents, files.folder(spark, sf_dir, "ragged.csv"))
    good, rejects = read_csv_with_rejects(spark, path)
    told = good.groupBy(F.lit("good").alias("reason")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("key").alias("key_sum"), F.count("priority").alias("n_last")
    )
    key = F.substring_index("row", ",", 1).cast("bigint")
    return told.unionByName(
        rejects.groupBy("reason").agg(
            F.count(F.lit(1)).alias("n_rows"), F.sum(key).alias("key_sum"), F.sum("n_read").alias("n_last")
        )
    )


@query
def scan_guards(spark, sf_dir):
    """What opening a table that is not there, unknown or broken raises, and cleaning that leaves nothing."""
    path = sinks.write_csv(table(spark, sf_dir, "nation"), files.folder(spark, sf_dir, "guards.csv"))
    broken = files.folder(spark, sf_dir, "broken.parquet")
    spark.read.text(path).write.mode("overwrite").text(broken)
    empty = files.folder(spark, sf_dir, "no_prices.csv")
    prices = derived(spark, sf_dir, "PRICES").where("actual_price = 'N/A'")
    sinks.write_csv(prices, empty)
    tries = {
        "missing": lambda: readers.read_table(spark, path + "x.csv"),
        "unknown": lambda: readers.read_table(spark, path + "x.unknown"),
        "broken": lambda: readers.read_table(spark, broken),
        "nothing left": lambda: batch.process_file(spark, empty, files.folder(spark, sf_dir, "none.csv"), SAMPLE),
    }
    found = [("readable", str(readers.read_table(spark, path).count()))]
    for name, attempt in tries.items():
        try:
            attempt()
            found.append((name, "nothing raised"))
        except (TableReadError, batch.EmptyResultError) as error:
            found.append((name, type(error).__name__))
    return spark.createDataFrame(found, "attempt string, outcome string")


@query
def price_columns_missing(spark, sf_dir):
    """Columns that price cleaning needs and a table lacks."""
    given = {"prices": derived(spark, sf_dir, "PRICES"), "orders": table(spark, sf_dir, "orders")}
    given["partly"] = given["prices"].drop("selling_price")
    parts = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("input"), "n_rows", F.lit(",".join(missing_expected_columns(df))).alias("missing")
        )
        for name, df in given.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def _customers_file(spark, sf_dir, name, condition) -> str:
    return sinks.write_csv(_customer_text(spark, sf_dir).where(condition), files.folder(spark, sf_dir, name))


@query
def kept_table(spark, sf_dir):
    """A second call scans what the first one stored."""
    path = _customers_file(spark, sf_dir, "kept.csv", F.lit(True))
    first = kept(spark, path, lambda: readers.read_table(spark, path), typed=True)
    second = kept(spark, path, lambda: first.limit(0), typed=True)
    return second


@query
def kept_table_changed(spark, sf_dir):
    """A call after the files changed builds anew."""
    path = _customers_file(spark, sf_dir, "kept_changed.csv", F.col("c_custkey") % 2 == 0)
    kept(spark, path, lambda: readers.read_table(spark, path))
    _customers_file(spark, sf_dir, "kept_changed.csv", F.col("c_custkey") % 3 == 0)
    return kept(spark, path, lambda: readers.read_table(spark, path))


@query
def sink_csv_roundtrip(spark, sf_dir):
    cleaned = clean_and_sample(derived(spark, sf_dir, "PRICES"), SAMPLE, SEED, "o_orderkey", unique_key=True)
    path = sinks.write_sample_csv(cleaned, files.folder(spark, sf_dir, "sample.csv"))
    return rounded(readers.read_table(spark, path))


# Price cleaning and sampling -----------------------------------------------------


@query
def price_clean(spark, sf_dir):
    return clean_prices(derived(spark, sf_dir, "PRICES"))


@query
def price_clean_stream(spark, sf_dir):
    source = files.folder(spark, sf_dir, "stream_source")
    rows = derived(spark, sf_dir, "PRICES")
    rows.write.mode("overwrite").parquet(source)
    run = files.folder(spark, sf_dir, f"stream_{files.run_id()}")
    stream = spark.readStream.schema(rows.schema).parquet(source)
    write_clean_prices(stream, f"{run}/rows", f"{run}/checkpoint").awaitTermination()
    return spark.read.schema(clean_prices(rows).schema).parquet(f"{run}/rows")


@query
def price_clean_passthrough(spark, sf_dir):
    return clean_prices(table(spark, sf_dir, "events"))


@query
def sample_fraction(spark, sf_dir):
    return rounded(sample.sample_fraction(table(spark, sf_dir, "orders"), SAMPLE), 12)


@query
def sample_bernoulli(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    fraction = sample.sampling_fraction(orders.count(), SAMPLE)
    return as_day(sample.bernoulli_sample(orders, fraction, SEED, "o_orderkey"), "o_orderdate")


@query
def sample_exact(spark, sf_dir):
    drawn = sample.exact_sample(table(spark, sf_dir, "orders"), SAMPLE, SEED, "o_orderkey", unique_key=True)
    return as_day(drawn, "o_orderdate")


@query
def sample_repeating_key(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linenumber")
    return sample.exact_sample(rows, SAMPLE, SEED, "l_suppkey")


@query
def process_file(spark, sf_dir):
    source = sinks.write_csv(derived(spark, sf_dir, "PRICES"), files.folder(spark, sf_dir, "process.csv"))
    target = files.folder(spark, sf_dir, "processed.csv")
    batch.process_file(spark, source, target, SAMPLE, SEED, "o_orderkey", unique_key=True)
    return rounded(readers.read_table(spark, target))


@query
def csv_roundtrip_text(spark, sf_dir):
    rows = table(spark, sf_dir, "documents")
    back = readers.read_table(spark, sinks.write_csv(rows, files.folder(spark, sf_dir, "documents.csv")))
    return back.select(*[F.md5(F.col(c).cast("string")).alias(c) for c in rows.columns])


@query
def scan_csv_long_ids(spark, sf_dir):
    path = sinks.write_csv(derived(spark, sf_dir, "LONG_IDS"), files.folder(spark, sf_dir, "long_ids.csv"))
    return readers.read_table(spark, path)


@query
def autoclean_long_ids(spark, sf_dir):
    return convert_text(derived(spark, sf_dir, "LONG_IDS"))


@query
def date_profile_slashed(spark, sf_dir):
    days = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 8 == 0, "unknown").otherwise(F.date_format("o_orderdate", "M/d/yyyy H:mm:ss")).alias("stamp")
    )
    return rounded(profile.date_profile(days))


@query
def date_profile_dayfirst(spark, sf_dir):
    """Day first, dotted, and moments with offsets: no value of a column contradicts its layout."""
    shown = {"slashed": "d/M/yyyy", "slashed_time": "dd/MM/yyyy HH:mm", "dotted": "dd.MM.yyyy", "named": "d MMMM yyyy"}
    days = table(spark, sf_dir, "orders").select(
        *[
            F.when(F.col("o_orderkey") % 10 == place, "unknown").otherwise(F.date_format("o_orderdate", pattern)).alias(name)
            for place, (name, pattern) in enumerate(shown.items())
        ],
        _with_offset().alias("zoned"),
    )
    return rounded(profile.date_profile(days))


@query
def null_counts_nan(spark, sf_dir):
    measures = derived(spark, sf_dir, "MEASURES").withColumn(
        "quantity", F.coalesce("quantity", F.lit(float("nan")))
    )
    total = profile.missing_cells(measures).select(
        F.lit(-1).alias("seq"), F.lit("all columns").alias("column"), F.col("missing_cells").alias("n_null")
    )
    return profile.null_counts(measures).unionByName(total)


@query
def clean_sample(spark, sf_dir):
    return clean_and_sample(derived(spark, sf_dir, "PRICES"), SAMPLE, SEED, "o_orderkey", unique_key=True)


@query
def preview(spark, sf_dir):
    return sample.preview(table(spark, sf_dir, "customer"), ["c_custkey"])


# Scalar functions ----------------------------------------------------------------


@query
def trim_text_whole(spark, sf_dir):
    padded = F.concat(F.lit("\t\u00a0\u2003 "), "text", F.lit(" \u3000\n"))
    trimmed = trim_text(padded)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.length(trimmed).alias("n_chars"), F.md5(trimmed).alias("digest")
    )


@query
def to_numeric_coerce(spark, sf_dir):
    texts = ("amount_text", "code_text", "half_text")
    return derived(spark, sf_dir, "MIXED").select(
        "o_orderkey", *[number(drop_marks(trim_text(F.col(name)))).alias(name) for name in texts]
    )


def _with_offset() -> Column:
    """Late evenings, some of them in other time zones."""
    zones = F.array(F.lit("Z"), F.lit("+02:00"), F.lit("-0530"), F.lit(" +01"))
    zone = F.get(zones, (F.col("o_orderkey") % 4).cast("int"))
    return F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'23:30:05"), zone)


@query
def date_parse(spark, sf_dir):
    formats = {
        "iso_date": "yyyy-MM-dd",
        "iso_timestamp": "yyyy-MM-dd HH:mm:ss",
        "slashed": "MM/dd/yyyy",
        "month_name": "MMM d, yyyy",
        "compact": "yyyyMMdd",
        "slashed_time": "M/d/yyyy H:mm:ss",
        "year_first": "yyyy/MM/dd",
        "day_month": "d-MMM-yyyy",
        "full_month": "MMMM d, yyyy",
        "day_slashed": "d/M/yyyy",
        "day_slashed_time": "dd/MM/yyyy H:mm",
        "dotted": "dd.MM.yyyy",
        "plain_month": "MMM d yyyy",
        "day_full_month": "d MMMM yyyy",
        "day_month_name": "dd MMM yyyy",
    }
    assert [*formats, "iso_offset"] == list(LAYOUTS)
    known = F.col("o_orderkey") % 8 != 0
    texts = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        _with_offset().alias("iso_offset"),
        *[F.when(known, F.date_format("o_orderdate", p)).otherwise("unknown").alias(name) for name, p in formats.items()],
    )
    return texts.select(
        "o_orderkey",
        parse_date(F.col("iso_offset"), "iso_offset").alias("iso_offset"),
        *[parse_date(F.col(layout), layout).cast("date").alias(layout) for layout in formats],
    )


# Profiles ------------------------------------------------------------------------


@query
def dataset_shape(spark, sf_dir):
    return profile.dataset_shape(table(spark, sf_dir, "lineitem"))


@query
def null_counts(spark, sf_dir):
    return profile.null_counts(derived(spark, sf_dir, "MIXED"))


@query
def missing_cells(spark, sf_dir):
    return profile.missing_cells(derived(spark, sf_dir, "MIXED"))


@query
def column_roles(spark, sf_dir):
    return profile.column_roles(derived(spark, sf_dir, "MIXED"))


@query
def text_profile(spark, sf_dir):
    return rounded(profile.text_profile(derived(spark, sf_dir, "MIXED")))


@query
def date_profile(spark, sf_dir):
    return rounded(profile.date_profile(derived(spark, sf_dir, "MIXED")))


@query
def distinct_counts(spark, sf_dir):
    return frequency.distinct_counts(table(spark, sf_dir, "part"))


@query
def value_counts(spark, sf_dir):
    return frequency.value_counts(table(spark, sf_dir, "events"), "event_type")


@query
def mode_per_column(spark, sf_dir):
    return frequency.modes(derived(spark, sf_dir, "MIXED"))


@query
def mode_long_text(spark, sf_dir):
    """Long texts that are nearly unique, next to columns with few values."""
    found = frequency.modes(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), ["text", "doc_id", "lang", "source"])
    return found.select("column", F.md5("value").alias("digest"), "n")


@query
def median_per_column(spark, sf_dir):
    return rounded(median.median_per_column(table(spark, sf_dir, "lineitem")))


@query
def median_narrowed(spark, sf_dir):
    """The same medians from a coarse sketch, so that more has to be narrowed down."""
    lineitem = table(spark, sf_dir, "lineitem")
    names = [name for name, kind in lineitem.dtypes if kind in ("double", "int", "bigint")]
    medians = median.exact_medians(lineitem, names, accuracy=50)
    return rounded(spark.createDataFrame(list(medians.items()), "column string, median double"))


# Cleaning ------------------------------------------------------------------------


@query
def impute_median(spark, sf_dir):
    return impute.impute_median(derived(spark, sf_dir, "MIXED"))


@query
def impute_mode(spark, sf_dir):
    return impute.impute_mode(derived(spark, sf_dir, "MIXED"))


@query
def impute_mode_unique(spark, sf_dir):
    """Gaps in long texts of which hardly any comes twice."""
    gap = F.when(F.col("doc_id") % 10 != 0, F.col("text"))
    filled = impute.impute_mode(table(spark, sf_dir, "documents").select("doc_id", gap.alias("text")))
    return filled.select("doc_id", F.md5("text").alias("digest"))


@query
def autoclean_text(spark, sf_dir):
    return convert_text(derived(spark, sf_dir, "MIXED"))


@query
def autoclean_text_strip_all(spark, sf_dir):
    return convert_text(derived(spark, sf_dir, "MIXED"), strip_all=True)


@query
def auto_cleaned(spark, sf_dir):
    return auto_clean(derived(spark, sf_dir, "MIXED"))[0]


@query
def cleaning_report(spark, sf_dir):
    report = auto_clean(derived(spark, sf_dir, "MIXED"))[1]
    is_number = F.col("action") == "filled_median"
    fill = F.when(is_number, F.format_number(F.col("fill_value").try_cast("double"), 3))
    return report.select(
        "seq", "action", "column", "n_changed", F.coalesce(fill, "fill_value").alias("fill_value")
    )


# Charts --------------------------------------------------------------------------

LINEITEM_MEASURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query
def kpi_totals(spark, sf_dir):
    return rounded(charts.kpi_totals(table(spark, sf_dir, "lineitem"), LINEITEM_MEASURES), 2)


@query
def kpi_totals_default(spark, sf_dir):
    return rounded(charts.kpi_totals(table(spark, sf_dir, "lineitem")), 2)


@query
def date_span(spark, sf_dir):
    return charts.date_span(table(spark, sf_dir, "lineitem"), "l_shipdate").select(
        F.col("first").cast("date").alias("first"), F.col("last").cast("date").alias("last"), "days"
    )


@query
def trend_year(spark, sf_dir):
    return rounded(charts.trend(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "year"))


@query
def trend_month(spark, sf_dir):
    return rounded(charts.trend(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice", "month"))


@query
def trend_week(spark, sf_dir):
    return rounded(charts.trend(table(spark, sf_dir, "events"), "ts", "value", "week"))


@query
def trend_day(spark, sf_dir):
    return rounded(charts.trend(table(spark, sf_dir, "events"), "ts", "value", "day"))


@query
def trend_auto(spark, sf_dir):
    return rounded(charts.trend_auto(table(spark, sf_dir, "orders"), "o_orderdate", "o_totalprice"))


@query
def trend_auto_short(spark, sf_dir):
    return rounded(charts.trend_auto(table(spark, sf_dir, "events"), "ts", "value"))


@query
def topn_other_15(spark, sf_dir):
    return charts.top_n_with_other(table(spark, sf_dir, "part"), "p_brand", charts.BAR_VALUES)


@query
def topn_other_10(spark, sf_dir):
    return charts.top_n_with_other(table(spark, sf_dir, "documents"), "source", charts.SHARE_VALUES)


@query
def topn_other_reserved(spark, sf_dir):
    return charts.top_n_with_other(derived(spark, sf_dir, "RESERVED"), "p_brand")


@query
def category_share(spark, sf_dir):
    return rounded(charts.category_share(table(spark, sf_dir, "orders"), "o_orderpriority"))


@query
def category_share_other(spark, sf_dir):
    return rounded(charts.category_share(table(spark, sf_dir, "documents"), "source"))


@query
def histogram(spark, sf_dir):
    return rounded(charts.histogram(table(spark, sf_dir, "lineitem"), "l_extendedprice", 20))


@query
def correlation_matrix(spark, sf_dir):
    return rounded(charts.correlation_matrix(derived(spark, sf_dir, "MEASURES")), 6)


@query
def correlation_far_values(spark, sf_dir):
    """A few values far away in rows that most pairs lack, and one column far from zero."""
    return rounded(charts.correlation_matrix(derived(spark, sf_dir, "FAR_VALUES")), 6)


@query
def correlation_wide(spark, sf_dir):
    return rounded(charts.correlation_matrix(derived(spark, sf_dir, "WIDE")), 6)


@query
def scatter_points(spark, sf_dir):
    return charts.scatter_points(
        table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag"
    )


@query
def scatter_sample(spark, sf_dir):
    return charts.scatter_points(
        table(spark, sf_dir, "orders"), "o_custkey", "o_totalprice", "o_orderstatus",
        SAMPLE, SEED, "o_orderkey", unique_key=True,
    )


@query
def scatter_grid(spark, sf_dir):
    return charts.scatter_grid(
        table(spark, sf_dir, "lineitem"), "l_quantity", "l_extendedprice", "l_returnflag", 40
    )


# Choices and whole workflows -----------------------------------------------------


def _chart_rows(built: dict[str, DataFrame]) -> DataFrame:
    digits = F.when(F.col("chart") == "kpis", F.round("value", 2)).otherwise(F.round("value", 4))
    ends = {name: F.round(name, 4) for name in ("low", "high")}
    return chart_plans.chart_table(built).withColumns({"value": digits, **ends})


@query
def default_columns(spark, sf_dir):
    return chart_plans.default_columns(table(spark, sf_dir, "part"))


@query
def default_columns_dated(spark, sf_dir):
    return chart_plans.default_columns(table(spark, sf_dir, "lineitem"))


@query
def colour_candidates(spark, sf_dir):
    names = chart_plans.colour_candidates(table(spark, sf_dir, "part"))
    return spark.createDataFrame(list(enumerate([None, *names])), "seq int, column string")


@query
def quick_facts(spark, sf_dir):
    return quick_fact(table(spark, sf_dir, "lineitem"))


@query
def dataset_insights(spark, sf_dir):
    return insights(auto_clean(derived(spark, sf_dir, "MIXED"))[0])


@query
def dataset_insights_raw(spark, sf_dir):
    return insights(derived(spark, sf_dir, "MIXED"))


@query
def chart_data(spark, sf_dir):
    built = chart_plans.chart_data(derived(spark, sf_dir, "MIXED"), colour="priority")
    return _chart_rows(built)


@query
def chart_data_raw(spark, sf_dir):
    built = chart_plans.chart_data(derived(spark, sf_dir, "MIXED"), clean=False)
    return _chart_rows(built)


@query
def chart_data_bar(spark, sf_dir):
    built = chart_plans.chart_data(table(spark, sf_dir, "part"))
    return _chart_rows(built)
