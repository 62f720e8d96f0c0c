"""Checked queries: reading, cleaning and writing transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.catalog import sqltext as S
from tillcast.catalog.registry import day, query, rounded, shown
from tillcast.catalog.tables import HOME, LABELS, dealt_dirty_lines, dirty_lines, table, transactions
from tillcast.constants import LINE_KEY
from tillcast.functions import coercion as C
from tillcast.operators import cleaning as CL
from tillcast.operators.markets import top_countries
from tillcast.plans.ingest import ingest_directory
from tillcast.session import materialise, released_shuffles, scratch_path
from tillcast.sinks import tables as W
from tillcast.sources import invoices as INV

LINES_PER_EXPORT = 4000
EXPORT_PATTERN = "part-*.txt"
_written: dict[tuple[str, str], str] = {}


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CL.drop_bad_debt(transactions(spark, sf_dir))


# --- raw exports written from the tables ---------------------------------------------------------

def exports(spark: SparkSession, sf_dir: str) -> str:
    """A folder of JSON array files that holds every dirty line, copies too, with faulty files among them.

    Lines are dealt to files by arithmetic on their keys; each file stays at a few thousand lines.
    One file in seven is cut off, one in five lacks a field, one in three has odd elements.
    """
    known = (spark.sparkContext.applicationId, sf_dir)
    if known in _written:
        return _written[known]
    n_files = table(spark, sf_dir, "lineitem").count() // LINES_PER_EXPORT + 1
    number = F.pmod(F.col("o_orderkey") * 31 + F.col("l_partkey") * 17, F.lit(n_files))
    dealt = dealt_dirty_lines(spark, sf_dir, number).drop("source_file")
    file_no = F.col("file_no")
    values = {c: F.col(c) for c in dealt.columns if c != "file_no"}
    canonical = F.to_json(F.struct(*[v.alias(c) for c, v in values.items()]))
    spelled = {"price": "total_price", "stream_id": "StreamID", "times_viewed": "TimesViewed"}
    varied = F.to_json(F.struct(*[v.alias(spelled.get(c, c)) for c, v in values.items()]))
    lacking = F.to_json(F.struct(*[v.alias(c) for c, v in values.items() if c != "stream_id"]))
    record = F.when(file_no % 5 == 4, lacking).when(file_no % 2 == 0, canonical).otherwise(varied)
    body = F.array_join(F.collect_list("record"), ",")
    odd = F.when(F.col("file_no") % 3 == 2, F.lit(',7,"x",null,[1]')).otherwise("")
    close = F.when(F.col("file_no") % 7 == 6, F.lit("")).otherwise("]")
    path = scratch_path(spark, "exports")
    with released_shuffles(spark):
        (
            dealt.select("file_no", record.alias("record")).groupBy("file_no").agg(body.alias("body"))
            .select(F.concat(F.lit("["), F.col("body"), odd, close).alias("value"))
            .write.option("maxRecordsPerFile", 1).text(path)
        )
    _written[known] = path
    return path


EXPORTED = S.DIRTY_SQL + f""",
dealt AS (
  SELECT *, (order_no * 31 + CAST(trim(stream_id) AS BIGINT) * 17)
            % ((SELECT count(*) FROM lineitem) // {LINES_PER_EXPORT} + 1) AS file_no
  FROM dirty
),
sizes AS (SELECT file_no, count(*) AS n FROM dealt GROUP BY file_no),
outcome AS (
  SELECT file_no,
         CASE WHEN file_no % 7 = 6 THEN 'unreadable' WHEN file_no % 5 = 4 THEN 'missing_columns' ELSE 'loaded' END AS file_status,
         CASE WHEN file_no % 7 = 6 THEN 0 ELSE n END AS n_objects,
         CASE WHEN file_no % 7 <> 6 AND file_no % 3 = 2 THEN 4 ELSE 0 END AS n_odd
  FROM sizes
)"""


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return INV.read_exports(spark, exports(spark, sf_dir), EXPORT_PATTERN)


@query("scan_invoice_dir", f"""WITH {EXPORTED}
SELECT CAST(count(*) AS BIGINT) AS n_files, CAST(sum(n_objects + n_odd) AS BIGINT) AS n_elements FROM outcome""")
def scan_invoice_dir(spark, sf_dir):
    return scanned(spark, sf_dir).agg(
        F.count_if(F.col("drop_reason") == CL.FILE_MARKER).alias("n_files"),
        F.count_if(F.col("drop_reason").isNull() | (F.col("drop_reason") != CL.FILE_MARKER)).alias("n_elements"),
    )


@query("parse_json_array", f"""WITH {EXPORTED}
SELECT file_status, CAST(count(*) AS BIGINT) AS n_files FROM outcome GROUP BY file_status""")
def parse_json_array(spark, sf_dir):
    return INV.file_outcomes(scanned(spark, sf_dir)).groupBy("file_status").agg(F.count(F.lit(1)).alias("n_files"))


@query("drop_non_object_records", f"""WITH {EXPORTED}
SELECT file_status, CAST(sum(n_odd) AS BIGINT) AS n_dropped, CAST(sum(n_objects) AS BIGINT) AS n_records
FROM outcome WHERE n_objects > 0 GROUP BY file_status""")
def drop_non_object_records(spark, sf_dir):
    dropped = F.col("drop_reason") == CL.BAD_RECORD
    return INV.element_rows(scanned(spark, sf_dir)).groupBy("file_status").agg(
        F.count_if(dropped).alias("n_dropped"), (F.count(F.lit(1)) - F.count_if(dropped)).alias("n_records"),
    )


@query("require_columns", f"""WITH {EXPORTED}
SELECT file_status = 'missing_columns' AS is_skipped, CAST(sum(n_objects) AS BIGINT) AS n_records
FROM outcome WHERE n_objects > 0 GROUP BY 1""")
def require_columns(spark, sf_dir):
    rows = INV.element_rows(scanned(spark, sf_dir)).where(F.col("drop_reason").isNull() | (F.col("drop_reason") == CL.SKIPPED_FILE))
    return rows.groupBy((F.col("file_status") == INV.MISSING_COLUMNS).alias("is_skipped")).agg(F.count(F.lit(1)).alias("n_records"))


@query("canonicalise_columns", f"""WITH {EXPORTED}
SELECT stream_id, times_viewed, CAST(count(*) AS BIGINT) AS n, CAST(count(price) AS BIGINT) AS n_prices
FROM dealt WHERE file_no % 7 <> 6 AND file_no % 5 <> 4 GROUP BY stream_id, times_viewed""")
def canonicalise_columns(spark, sf_dir):
    rows = scanned(spark, sf_dir).where(F.col("drop_reason").isNull())
    return rows.groupBy("stream_id", "times_viewed").agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("n_prices"))


INGESTED = EXPORTED + """,
loaded AS (
  SELECT country, customer_id, invoice, stream_id, price, times_viewed, year, month, day, '' AS source_file
  FROM dealt WHERE file_no % 7 <> 6 AND file_no % 5 <> 4
),""" + S.coerced("loaded")


def _report_sql(source: str, files: str = "") -> str:
    def dropped(reason):
        return f"(SELECT CAST(count(*) AS BIGINT) FROM ruled WHERE drop_reason = '{reason}')"

    return f"""SELECT {files}
  {dropped('missing_required_field')} AS rows_dropped_missing_required_field,
  {dropped('invalid_date')} AS rows_dropped_invalid_date,
  {dropped('invalid_price')} AS rows_dropped_invalid_price,
  {dropped('bad_debt_adjustment')} AS rows_dropped_bad_debt_adjustment,
  (SELECT CAST(count(*) AS BIGINT) FROM ruled WHERE drop_reason IS NULL)
    - (SELECT CAST(count(*) AS BIGINT) FROM kept) AS rows_dropped_exact_duplicate,
  (SELECT CAST(count(*) AS BIGINT) FROM kept) AS rows_kept"""


FILE_COUNTS = """
  (SELECT CAST(count(*) AS BIGINT) FROM outcome) AS files_found,
  (SELECT CAST(count(*) AS BIGINT) FROM outcome WHERE file_status = 'loaded') AS files_loaded,
  (SELECT CAST(count(*) AS BIGINT) FROM outcome WHERE file_status <> 'loaded') AS files_failed,
  (SELECT CAST(sum(n_objects + n_odd) AS BIGINT) FROM outcome) AS rows_read,
  (SELECT CAST(coalesce(sum(n_objects), 0) AS BIGINT) FROM outcome WHERE file_status = 'missing_columns') AS rows_in_skipped_files,
  (SELECT CAST(sum(n_odd) AS BIGINT) FROM outcome) AS rows_dropped_bad_json_record,"""


@query("write_ingestion_report", f"WITH {INGESTED} " + _report_sql("ruled", FILE_COUNTS))
def write_ingestion_report(spark, sf_dir):
    report = ingest_directory(spark, exports(spark, sf_dir), EXPORT_PATTERN).report
    path = scratch_path(spark, "report")
    W.write_report(report, path)
    return spark.read.schema(report.schema).json(path)


@query("failed_export_files", f"""WITH {INGESTED}
SELECT file_status, count(*) AS n_files FROM outcome WHERE file_status <> 'loaded' GROUP BY file_status""")
def failed_export_files(spark, sf_dir):
    """The table of rejected files, by what is wrong with them: their names are given by the writer."""
    failed = ingest_directory(spark, exports(spark, sf_dir), EXPORT_PATTERN).failed_files
    return failed.groupBy("file_status").agg(F.count("source_file").alias("n_files"))


@query("ingest_exports", f"""WITH {INGESTED}
SELECT {day('date')}, country, customer_id, invoice, stream_id, price, times_viewed FROM kept""")
def ingest_exports(spark, sf_dir):
    done = ingest_directory(spark, exports(spark, sf_dir), EXPORT_PATTERN).transactions
    return shown(done.select("date", "country", "customer_id", "invoice", "stream_id", "price", "times_viewed"))


# --- cleaning of the dirty lines -----------------------------------------------------------------

def tagged(spark, sf_dir):
    return CL.tag_lines(dirty_lines(spark, sf_dir))


@query("trim_strings", f"""WITH {S.DIRTY_SQL}
SELECT trim(country) AS country, trim(invoice) AS invoice, CAST(count(DISTINCT trim(stream_id)) AS BIGINT) AS n_streams
FROM dirty GROUP BY 1, 2""")
def trim_strings(spark, sf_dir):
    trimmed = CL.trim_strings(dirty_lines(spark, sf_dir))
    return trimmed.groupBy("country", "invoice").agg(F.countDistinct("stream_id").alias("n_streams"))


@query("split_invoice_id", f"""WITH {S.TXN_SQL}
SELECT invoice, regexp_extract(invoice, '^([A-Za-z]*)(.*)$', 1) AS invoice_prefix,
       regexp_extract(invoice, '^([A-Za-z]*)(.*)$', 2) AS invoice_clean, CAST(count(*) AS BIGINT) AS n
FROM txn GROUP BY invoice""")
def split_invoice_id(spark, sf_dir):
    lines = transactions(spark, sf_dir).groupBy("invoice").agg(F.count(F.lit(1)).alias("n"))
    return CL.split_invoice(lines)


@query("coerce_customer_id", f"""WITH {S.CLEANED}
SELECT customer_id, CAST(count(*) AS BIGINT) AS n FROM coerced GROUP BY customer_id""")
def coerce_customer_id(spark, sf_dir):
    ids = dirty_lines(spark, sf_dir).select(C.whole_number(F.col("customer_id")).alias("customer_id"))
    return ids.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n"))


@query("coerce_price", f"""WITH {S.CLEANED}
SELECT price, CAST(count(*) AS BIGINT) AS n FROM coerced GROUP BY price""")
def coerce_price(spark, sf_dir):
    prices = dirty_lines(spark, sf_dir).select(C.finite_number(F.col("price")).alias("price"))
    return prices.groupBy("price").agg(F.count(F.lit(1)).alias("n"))


@query("coerce_views", f"""WITH {S.CLEANED}
SELECT times_viewed, CAST(count(*) AS BIGINT) AS n FROM coerced GROUP BY times_viewed""")
def coerce_views(spark, sf_dir):
    views = dirty_lines(spark, sf_dir).select(C.truncated_or_zero(F.col("times_viewed")).alias("times_viewed"))
    return views.groupBy("times_viewed").agg(F.count(F.lit(1)).alias("n"))


@query("assemble_date", f"""WITH {S.CLEANED}
SELECT {day('date')}, CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month, CAST(day(date) AS BIGINT) AS day,
       CAST(count(*) AS BIGINT) AS n FROM coerced GROUP BY date""")
def assemble_date(spark, sf_dir):
    lines = dirty_lines(spark, sf_dir).select(C.calendar_date(F.col("year"), F.col("month"), F.col("day")).alias("date"))
    counted = lines.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    return shown(counted.select("date", F.year("date").alias("year"), F.month("date").alias("month"), F.dayofmonth("date").alias("day"), "n"))


@query("require_fields", f"""WITH {S.CLEANED}
SELECT country, CAST(count(*) AS BIGINT) AS n, CAST(count(customer_id) AS BIGINT) AS n_customers
FROM ruled WHERE drop_reason IS NULL OR drop_reason = 'bad_debt_adjustment' GROUP BY country""")
def require_fields(spark, sf_dir):
    """Counted under the rule: a filter on the reason would be pushed below the join and parse every text again for each rule."""
    kept = F.coalesce(F.col("drop_reason"), F.lit(CL.BAD_DEBT)) == CL.BAD_DEBT
    counted = tagged(spark, sf_dir).withColumn("kept", kept).groupBy("country").agg(
        F.count_if("kept").alias("n"), F.count_if(F.col("kept") & F.col("customer_id").isNotNull()).alias("n_customers"),
    )
    return counted.where(F.col("n") > 0)


@query("drop_bad_debt", f"""WITH {S.CLEAN}
SELECT invoice_prefix, country, CAST(count(*) AS BIGINT) AS n, round(sum(price), 2) AS revenue
FROM clean GROUP BY invoice_prefix, country""")
def drop_bad_debt(spark, sf_dir):
    kept = CL.drop_bad_debt(transactions(spark, sf_dir))
    return shown(kept.groupBy("invoice_prefix", "country").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("revenue")), revenue=2)


@query("dedup_exact", f"""WITH {S.CLEANED}
SELECT country, customer_id, invoice, stream_id, price, times_viewed, {day('date')}, source_file FROM kept""")
def dedup_exact(spark, sf_dir):
    """Through the collapsed table, as in the ingest plan: a filter on the raw rules would repeat their parsing."""
    collapsed = materialise(CL.collapse_lines(tagged(spark, sf_dir)), "collapsed")
    return shown(CL.clean_lines(collapsed).select(*LINE_KEY, "source_file"))


@query("ingestion_report", f"WITH {S.CLEANED} " + _report_sql(
    "ruled", "(SELECT CAST(count(*) AS BIGINT) FROM ruled) AS rows_read,"
))
def ingestion_report(spark, sf_dir):
    report = CL.audit_report(CL.collapse_lines(tagged(spark, sf_dir)))
    return report.drop("rows_in_skipped_files", "rows_dropped_bad_json_record")


@query("as_of_filter", f"""WITH {S.CLEAN}
SELECT {day('date')}, CAST(count(*) AS BIGINT) AS n, round(sum(price), 2) AS revenue
FROM clean WHERE date <= DATE '1999-06-30' GROUP BY date""")
def as_of_filter(spark, sf_dir):
    kept = CL.up_to(clean(spark, sf_dir), "1999-06-30")
    return shown(kept.groupBy("date").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("revenue")), revenue=2)


@query("exclude_labels", f"""WITH {S.CLEAN}
SELECT country, CAST(count(*) AS BIGINT) AS n FROM clean WHERE {S.MARKETS} AND country <> '{HOME}' GROUP BY country""")
def exclude_labels(spark, sf_dir):
    kept = CL.only_markets(clean(spark, sf_dir), True, LABELS, HOME)
    return kept.groupBy("country").agg(F.count(F.lit(1)).alias("n"))


@query("union_sources", f"""WITH {S.CLEAN},
both_sources AS (
  SELECT 'first' AS data_source, * FROM clean WHERE date < DATE '1999-01-01'
  UNION ALL SELECT 'second', * FROM clean WHERE date >= DATE '1998-01-01'
)
SELECT data_source, country, CAST(count(*) AS BIGINT) AS n, round(sum(price), 2) AS revenue
FROM both_sources GROUP BY data_source, country""")
def union_sources(spark, sf_dir):
    lines = clean(spark, sf_dir)
    day0, day1 = F.lit("1999-01-01").cast("date"), F.lit("1998-01-01").cast("date")
    both = CL.union_sources({"first": lines.where(F.col("date") < day0), "second": lines.where(F.col("date") >= day1)})
    return shown(both.groupBy("data_source", "country").agg(F.count(F.lit(1)).alias("n"), F.sum("price").alias("revenue")), revenue=2)


# --- writing --------------------------------------------------------------------------------------

@query("write_transactions", f"""WITH {S.CLEAN}
SELECT CAST(year(date) AS BIGINT) AS year, CAST(month(date) AS BIGINT) AS month, country,
       CAST(count(*) AS BIGINT) AS n, CAST(count(customer_id) AS BIGINT) AS n_customers, round(sum(price), 2) AS revenue,
       CAST(sum(times_viewed) AS BIGINT) AS views
FROM clean GROUP BY ALL""")
def write_transactions(spark, sf_dir):
    path = scratch_path(spark, "transactions")
    W.write_transactions(clean(spark, sf_dir), path)
    back = spark.read.parquet(path)
    return shown(back.groupBy("year", "month", "country").agg(
        F.count(F.lit(1)).alias("n"), F.count("customer_id").alias("n_customers"), F.sum("price").alias("revenue"),
        F.sum("times_viewed").alias("views"),
    ), revenue=2)


@query("write_top_countries", f"""WITH {S.CLEAN}{S.TOP}
SELECT CAST(row_number() OVER (ORDER BY revenue DESC, country) - 1 AS BIGINT) AS rank, country FROM top""")
def write_top_countries(spark, sf_dir):
    path = scratch_path(spark, "top")
    W.write_top_countries(top_countries(clean(spark, sf_dir), labels=LABELS, home=HOME), path)
    return spark.read.csv(path, header=True, schema="rank bigint, country string")


@query("sort_transactions", f"""WITH {S.CLEAN}
SELECT {day('date')}, CAST(count(*) AS BIGINT) AS n, 0::BIGINT AS n_out_of_order FROM clean GROUP BY date""")
def sort_transactions(spark, sf_dir):
    """Reads the written table back and counts lines that precede an earlier date inside a file."""
    from pyspark.sql import Window

    path = scratch_path(spark, "sorted")
    W.write_transactions(clean(spark, sf_dir), path)
    back = spark.read.parquet(path).select("date", F.col("_metadata.file_path").alias("file")).withColumn(
        "position", F.monotonically_increasing_id()
    )
    in_file = Window.partitionBy("file").orderBy("position")
    return shown(back.withColumn("before", F.lag("date").over(in_file)).groupBy("date").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("before") > F.col("date")).alias("n_out_of_order"),
    ))
