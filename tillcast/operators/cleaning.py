"""Cleaning of raw text rows: coercion, rules in order, exact duplicates, audit counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillcast.constants import LINE_KEY, NON_MARKET_LABELS, TRANSACTION_COLUMNS
from tillcast.functions import coercion as C

INVALID_PRICE = "invalid_price"
INVALID_DATE = "invalid_date"
MISSING_FIELD = "missing_required_field"
BAD_DEBT = "bad_debt_adjustment"
BAD_RECORD = "bad_json_record"
SKIPPED_FILE = "in_skipped_file"
FILE_MARKER = "file_marker"


def calendar_parts() -> dict[str, Column]:
    return {"year": F.year("date"), "month": F.month("date"), "day": F.dayofmonth("date")}


def trim_strings(raw: DataFrame, columns=("country", "invoice", "stream_id")) -> DataFrame:
    return raw.withColumns({c: C.trimmed(F.col(c)) for c in columns})


def split_invoice(df: DataFrame) -> DataFrame:
    invoice = F.col("invoice")
    return df.withColumns({"invoice_prefix": C.letter_prefix(invoice), "invoice_clean": C.after_prefix(invoice)})


def coerce_lines(raw: DataFrame) -> DataFrame:
    """Typed columns in place of the text; nothing is dropped here.

    Done in steps that each read the previous one's columns, so every text is parsed once.
    """
    numbers = trim_strings(raw).withColumns({
        **{c: C.parsed_number(F.col(c)) for c in ("price", "times_viewed")},
        **{c: C.date_part(F.col(c)) for c in ("year", "month", "day")},
        "customer_id": C.plain_whole(F.col("customer_id")), "_id_number": C.parsed_number(F.col("customer_id")),
    })
    typed = numbers.withColumns({
        "customer_id": F.coalesce("customer_id", C.whole(F.col("_id_number"))),
        "price": C.finite(F.col("price")), "times_viewed": C.truncated(F.col("times_viewed")),
        "date": C.date_of_parts(F.col("year"), F.col("month"), F.col("day")),
    })
    return split_invoice(typed.drop("_id_number")).withColumns(calendar_parts())


def first_failed_rule() -> Column:
    """Name of the first rule a coerced line breaks, NULL for a good line. Order matters."""
    missing = (
        F.col("country").isNull() | F.lower("country").isin("", "nan")
        | F.col("invoice").isNull() | F.col("stream_id").isNull()
    )
    return (
        F.when(F.col("price").isNull(), INVALID_PRICE)
        .when(F.col("date").isNull(), INVALID_DATE)
        .when(missing, MISSING_FIELD)
        .when(F.upper("invoice_prefix") == "A", BAD_DEBT)
    )


def tag_lines(raw: DataFrame) -> DataFrame:
    """Coerced lines with ``drop_reason``; a reason the source already gave comes first."""
    earlier = F.col("drop_reason") if "drop_reason" in raw.columns else F.lit(None).cast("string")
    return coerce_lines(raw).withColumn("drop_reason", F.coalesce(earlier, first_failed_rule()))


def collapse_lines(tagged: DataFrame) -> DataFrame:
    """One row per distinct good line, per drop reason and per file, with its number of input rows.

    Copies collapse on the map side, so a line that makes up a third of the input moves as one row
    per task. Rejected lines carry no key. The first file by name keeps the line.
    """
    good = F.col("drop_reason").isNull()
    keys = [F.when(good, F.col(c)).alias(c) for c in LINE_KEY]
    if "file_status" in tagged.columns:
        marker = F.col("drop_reason") == FILE_MARKER
        keys += [F.when(marker, F.col("source_file")).alias("file"), F.when(marker, F.col("file_status")).alias("file_status")]
    return tagged.groupBy("drop_reason", *keys).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("source_file").alias("source_file")
    )


def clean_lines(collapsed: DataFrame) -> DataFrame:
    """The clean transaction table, in its fixed column order."""
    return with_derived(collapsed.where(F.col("drop_reason").isNull()))


def with_derived(kept: DataFrame) -> DataFrame:
    """The transaction table of good lines that have the columns of their key and ``source_file``; the rest follows from these."""
    return split_invoice(kept).withColumns(calendar_parts()).select(*TRANSACTION_COLUMNS)


def _file_counters(collapsed: DataFrame) -> list[Column]:
    if "file_status" not in collapsed.columns:
        return []
    marker = F.col("drop_reason") == FILE_MARKER
    failed = marker & (F.col("file_status") != "loaded")
    return [
        F.count_if(marker).alias("files_found"),
        F.count_if(marker & (F.col("file_status") == "loaded")).alias("files_loaded"),
        F.count_if(failed).alias("files_failed"),
    ]


def failed_files(collapsed: DataFrame) -> DataFrame:
    """(source_file, file_status) of the files that were found and not loaded."""
    failed = (F.col("drop_reason") == FILE_MARKER) & (F.col("file_status") != "loaded")
    return collapsed.where(failed).select(F.col("file").alias("source_file"), "file_status")


def audit_report(collapsed: DataFrame) -> DataFrame:
    """One row with the audit counters; they add up to ``rows_read``."""
    def rows(reason: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("drop_reason") == reason, F.col("n_rows"))), F.lit(0)).cast("bigint")

    good = F.col("drop_reason").isNull()
    lines = good | (F.col("drop_reason") != FILE_MARKER)
    return collapsed.agg(
        *_file_counters(collapsed),
        F.coalesce(F.sum(F.when(lines, F.col("n_rows"))), F.lit(0)).cast("bigint").alias("rows_read"),
        rows(SKIPPED_FILE).alias("rows_in_skipped_files"),
        rows(BAD_RECORD).alias("rows_dropped_bad_json_record"),
        rows(MISSING_FIELD).alias("rows_dropped_missing_required_field"),
        rows(INVALID_DATE).alias("rows_dropped_invalid_date"),
        rows(INVALID_PRICE).alias("rows_dropped_invalid_price"),
        rows(BAD_DEBT).alias("rows_dropped_bad_debt_adjustment"),
        F.coalesce(F.sum(F.when(good, F.col("n_rows") - 1)), F.lit(0)).cast("bigint").alias("rows_dropped_exact_duplicate"),
        F.count_if(good).alias("rows_kept"),
    )


def drop_bad_debt(df: DataFrame) -> DataFrame:
    return df.where(F.upper("invoice_prefix") != "A")


def drop_duplicate_lines(df: DataFrame) -> DataFrame:
    """Exact duplicates removed; NULLs count as equal and the first file by name wins."""
    return df.groupBy(*LINE_KEY).agg(F.min("source_file").alias("source_file"))


def up_to(df: DataFrame, as_of) -> DataFrame:
    return df.where(F.col("date") <= F.lit(as_of).cast("date"))


def only_markets(df: DataFrame, exclude_home: bool = False, labels=NON_MARKET_LABELS, home: str | None = None) -> DataFrame:
    """Rows of real markets: labels compare without case, the home market with case."""
    kept = df.where(~F.lower("country").isin(*labels))
    return kept.where(F.col("country") != home) if exclude_home else kept


def union_sources(frames: dict[str, DataFrame], dedup_across_sources: bool = False) -> DataFrame:
    """UNION ALL of the sources, each tagged; overlapping sources double count unless asked otherwise."""
    if not frames:
        raise ValueError("no sources given")
    tagged = [df.withColumn("data_source", F.lit(name)) for name, df in frames.items()]
    combined = tagged[0]
    for other in tagged[1:]:
        combined = combined.unionByName(other, allowMissingColumns=True)
    if not dedup_across_sources:
        return combined
    first = F.min(F.struct("data_source", "source_file")).alias("first_seen")
    kept = combined.groupBy(*LINE_KEY).agg(first).select(*LINE_KEY, "first_seen.*")
    return split_invoice(kept).withColumns(calendar_parts()).select(*TRANSACTION_COLUMNS, "data_source")
