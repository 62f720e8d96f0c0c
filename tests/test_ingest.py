import json

import pytest
from pyspark.sql import functions as F

from tillcast.operators.daily import daily_series, unknown_series
from tillcast.operators.markets import top_countries
from tillcast.plans.ingest import ingest_directories, ingest_directory
from tillcast.sources.invoices import IngestionError

LINE = {"country": "France", "customer_id": 111.0, "invoice": "500001", "price": 10.0, "stream_id": "85123",
        "times_viewed": 2, "year": "2018", "month": "01", "day": "05"}


def export(folder, name, content):
    (folder / name).write_text(content if isinstance(content, str) else json.dumps(content))


def test_unusable_folders(spark, tmp_path):
    with pytest.raises(IngestionError):
        ingest_directory(spark, str(tmp_path / "absent"))
    with pytest.raises(IngestionError):
        ingest_directory(spark, str(tmp_path))
    export(tmp_path, "invoices-2018-01.json", "{broken")
    with pytest.raises(IngestionError):
        ingest_directory(spark, str(tmp_path / "invoices-2018-01.json"))
    with pytest.raises(IngestionError):
        ingest_directory(spark, str(tmp_path))


def test_every_rule_is_counted_once(spark, tmp_path):
    other = {"country": "France", "customer_id": 222, "invoice": "C5", "total_price": 20, "StreamID": 85,
             "TimesViewed": 4, "year": 2018, "month": 1, "day": 6, "extra": {"a": [1]}}
    export(tmp_path, "invoices-2018-01.json", [
        LINE, LINE, 7, "x", None, [1], {**LINE, "price": "N/A"}, {**LINE, "price": "5d"}, {**LINE, "price": True},
        {**LINE, "month": "13"}, {**LINE, "day": "31", "month": "02"}, {**LINE, "country": None}, {**LINE, "country": " nan "},
        {**LINE, "invoice": None}, {**LINE, "invoice": "A900001", "price": -50000, "customer_id": None},
        {**LINE, "customer_id": 12.5, "times_viewed": "x", "stream_id": 7}, {**LINE, "times_viewed": 2.9, "invoice": "500002"},
    ])
    export(tmp_path, "invoices-2018-02.json", [other, LINE])
    export(tmp_path, "invoices-2018-03.json", "{broken")
    export(tmp_path, "invoices-2018-04.json", LINE)
    export(tmp_path, "invoices-2018-05.json", [])
    export(tmp_path, "invoices-2018-06.json", [3, 4])
    export(tmp_path, "invoices-2018-07.json", [{k: v for k, v in LINE.items() if k != "price"}])
    export(tmp_path, "invoices-2018-08.json", json.dumps([LINE]) + " trailing")
    done = ingest_directory(spark, str(tmp_path))
    report = done.report.first().asDict()
    assert report["files_found"] == 8 and report["files_loaded"] == 2
    assert report["files_failed"] == 6
    assert {tuple(r) for r in done.failed_files.collect()} == {
        (f"invoices-2018-0{i}.json", status) for i, status in (
            (3, "unreadable"), (4, "unreadable"), (5, "unreadable"), (6, "no_records"), (7, "missing_columns"), (8, "unreadable"),
        )
    }
    assert report["rows_dropped_bad_json_record"] == 6 and report["rows_in_skipped_files"] == 1
    assert report["rows_dropped_invalid_price"] == 3 and report["rows_dropped_invalid_date"] == 2
    assert report["rows_dropped_missing_required_field"] == 3 and report["rows_dropped_bad_debt_adjustment"] == 1
    assert report["rows_dropped_exact_duplicate"] == 2 and report["rows_kept"] == 4
    assert report["rows_read"] == report["rows_kept"] + report["rows_in_skipped_files"] + sum(
        v for k, v in report.items() if k.startswith("rows_dropped")
    )
    rows = {r["stream_id"] + "/" + r["invoice"]: r for r in done.transactions.collect()}
    assert rows["85/C5"]["price"] == 20.0 and rows["85/C5"]["invoice_prefix"] == "C" and rows["85/C5"]["invoice_clean"] == "5"
    assert rows["7/500001"]["customer_id"] is None and rows["7/500001"]["times_viewed"] == 0
    assert rows["85123/500002"]["times_viewed"] == 2
    assert rows["85123/500001"]["source_file"] == "invoices-2018-01.json"


def test_directories_add_up_unless_deduplicated(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        export(tmp_path / name, "invoices-2018-01.json", [LINE])
    both = [str(tmp_path / "a"), str(tmp_path / "b")]
    assert ingest_directories(spark, both)[0].count() == 2
    assert ingest_directories(spark, both, dedup_across_sources=True)[0].count() == 1
    with pytest.raises(IngestionError):
        ingest_directories(spark, [*both, str(tmp_path / "c")])
    assert ingest_directories(spark, [*both, str(tmp_path / "c")], skip_failed=True)[0].count() == 2


def lines(spark, rows):
    return spark.createDataFrame(
        [(d, c, i, s, k, float(p), v) for d, c, i, s, k, p, v in rows],
        "date string, country string, invoice_clean string, stream_id string, customer_id bigint, price double, times_viewed bigint",
    ).withColumn("date", F.col("date").cast("date"))


def test_labels_do_not_rank(spark):
    table = lines(spark, [("2018-01-01", "Unspecified", "1", "s", 1, 999, 1), ("2018-01-01", "France", "2", "s", 1, 5, 1)])
    assert [r["country"] for r in top_countries(table, 2).collect()] == ["France"]


def test_gaps_are_zero_and_distincts_are_per_level(spark):
    table = lines(spark, [
        ("2018-01-01", "Germany", "1", "s", 1, 10.005, 3), ("2018-01-03", "Germany", "2", "s", None, 7, 1),
        ("2018-01-01", "France", "3", "s", 1, 5, 2),
    ])
    series = daily_series(table)
    german = series.where("series = 'Germany'").orderBy("date").collect()
    assert [r["revenue"] for r in german] == [10.0, 0.0, 7.0] and german[2]["unique_customers"] == 0
    first = series.where("series = 'overall'").orderBy("date").first()
    assert (first["purchases"], first["unique_streams"], first["unique_customers"], first["total_views"]) == (2, 1, 1, 5)
    asked = spark.createDataFrame([("Nowhere",), ("Germany",)], "series string")
    assert [r[0] for r in unknown_series(asked, series).collect()] == ["Nowhere"]


def test_text_behind_the_array_makes_a_file_unreadable(spark):
    from tillcast.sources.invoices import REQUIRED_FIELDS, file_outcomes, parse_exports

    one = "{" + ", ".join(f'"{f}": "a ] }} \\" [ {{"' for f in REQUIRED_FIELDS) + ', "more": [[1], {"x": [2]}]}'
    texts = {
        "good": f"[{one}]", "two": f"[{one}, {one}] ", "strings": f'["[ {{", {one}]', "again": f"[{one}][{one}]", "comma": f"[{one}],[{one}]",
        "junk": f"[{one}] junk]", "closed": f"[{one}]]",
    }
    rows = parse_exports(spark.createDataFrame([(t, n) for n, t in texts.items()], "value string, source_file string"))
    found = {r.source_file: r.file_status for r in file_outcomes(rows).collect()}
    assert found == {n: "loaded" if n in ("good", "two", "strings") else "unreadable" for n in texts}


def test_files_cut_anywhere_read_like_whole_ones(spark, tmp_path):
    from tillcast.sources.invoices import file_outcomes, read_exports

    odd = {**LINE, "country": 'a "} \\ [{', "more": {"x": [{"y": "}"}, {}]}}
    texts = {
        "invoices-a.json": json.dumps([{**odd, "invoice": str(k)} for k in range(40)], indent=1), "invoices-b.json": json.dumps([7, odd, "}", [1]]),
        "invoices-c.json": json.dumps([odd]) + "}", "invoices-d.json": " ", "invoices-e.json": json.dumps([odd, odd])[:-1] + ",]",
        "invoices-f.json": json.dumps([odd]) * 2, "invoices-g.json": json.dumps([odd, 5]).replace("}, 5", "} 5"), "invoices-h.json": "[{}]",
        "invoices-i.json": "]", "invoices-j.json": "[",
    }
    export(tmp_path, "invoices-k.json", "")  # a file of no bytes is not listed
    for name, text in texts.items():
        export(tmp_path, name, text)
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = {}
    try:
        for size in (kept, "997b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "0" if size == "997b" else "4m")
            rows = read_exports(spark, str(tmp_path))
            found[size] = sorted(map(str, rows.collect()))
            outcomes = dict(map(tuple, file_outcomes(rows).collect()))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
        spark.conf.set("spark.sql.files.openCostInBytes", "4m")
    assert found[kept] == found["997b"]
    assert len(found[kept]) == 40 + 4 + 1 + len(texts)
    assert outcomes == {
        **dict.fromkeys(texts, "unreadable"), "invoices-a.json": "loaded", "invoices-b.json": "loaded", "invoices-h.json": "missing_columns",
    }


def test_small_files_are_read_without_a_shuffle_and_beside_large_ones(spark, tmp_path):
    from tillcast.sources.invoices import file_outcomes, read_exports

    variants = {**LINE, "Price": 3, "PRICE": 4, "StreamID": 1}
    export(tmp_path, "invoices-a.json", [LINE, 7, variants, {k.upper(): v for k, v in LINE.items()}])
    assert "Exchange" not in read_exports(spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    export(tmp_path, "invoices-b.json", [{**LINE, "invoice": str(k)} for k in range(20)])
    export(tmp_path, "invoices-c.json", json.dumps([LINE] * 9)[:-1])
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes")
    found = []
    try:
        for size in (kept, "1000b", "1b"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            rows = read_exports(spark, str(tmp_path))
            found.append(sorted(map(str, rows.collect())))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept)
    assert found[0] == found[1] == found[2] and len(found[0]) == 4 + 20 + 3
    assert dict(map(tuple, file_outcomes(rows).collect())) == {f"invoices-{n}.json": s for n, s in zip("abc", ("loaded", "loaded", "unreadable"))}


def test_rules_are_not_parsed_again_for_a_filter(spark):
    import os

    import __spark_entry__ as entry

    sf_dir = "/root/testdata/sf0.001"
    if not os.path.isdir(sf_dir):
        pytest.skip("driver tables absent")
    plan = entry.queries()["require_fields"](spark, sf_dir)._jdf.queryExecution().optimizedPlan()
    joins = [line for line in plan.toString().split("\n") if "Join Inner" in line]
    assert joins and not any("regexp_extract" in line for line in joins)


def test_trimming_keeps_every_blank_rule(spark):
    from tillcast.functions.coercion import WHITESPACE, trimmed

    texts = [" a ", "　a\t ", "a b", "", "   ", "\t", " \x85 é ", "é", "~", "!", "\x7f", " ​ ", None, " \x1f1 "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select(trimmed(F.col("t")).alias("a"), F.btrim("t", F.lit(WHITESPACE)).alias("b")).collect()
    assert [r.a for r in found] == [r.b for r in found] == [t and t.strip(WHITESPACE) for t in texts]


def test_coercion_of_lines_is_small_enough_to_be_compiled(spark, tmp_path):
    from tillcast.operators.cleaning import collapse_lines, tag_lines
    from tillcast.sources.invoices import read_exports

    export(tmp_path, "invoices-a.json", [LINE, LINE])
    kept = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        lines = collapse_lines(tag_lines(read_exports(spark, str(tmp_path))))
        stages = lines._jdf.queryExecution().debug().codegenToSeq()
        sizes = [stages.apply(i)._3().maxMethodCodeSize() for i in range(stages.size())]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept)
    assert sizes and max(sizes) < 8000  # bytes of a method, above which the virtual machine only interprets it


def test_numbers_keep_their_blank_and_digit_rules(spark):
    import re

    from tillcast.functions import coercion as C

    cores = ["7", "+7", "-07.50", ".5", "5.", "1e3", "1E-2", "2018.0", "2018.00", "20180", "12.5", "9223372036854775808", "9" * 19, "9" * 20, "1e999",
             "5d", "inf", "NaN", "", ".", "1 2", "0x1", "1_0", "٣", "e5", "--1"]
    texts = [None, *(a + c + b for c in cores for a in ("", " ", "　\t") for b in ("", "\n", " \x85 ", "​"))]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    found = rows.select("t", C.parsed_number(F.col("t")).alias("n"), C.plain_whole(F.col("t")).alias("w"), C.date_part(F.col("t")).alias("p")).collect()
    for r in found:
        bare = (r.t or "").strip(C.WHITESPACE)
        number = re.fullmatch(r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?", bare)
        assert r.n == (float(bare) if number else None), r
        digits = re.fullmatch(r"[+-]?[0-9]{1,19}", bare)
        assert r.w == (int(bare) if digits and abs(int(bare)) < 1 << 63 else None), r
        part = re.fullmatch(r"([0-9]{1,4})(?:\.0*)?", bare)
        assert r.p == (int(part[1]) if part else None), r


def test_end_of_the_first_list_is_found_in_flat_and_nested_texts(spark):
    from tillcast.sources.invoices import ends_with_first_value

    texts = {
        "[]": True, "[{},{}]": True, "[{}][{}]": False, "[{}]]": False, "[{}{}]": True, '[{"a":"]\\"["}]': True, "[[1],{}]": True, "[{}": False,
        "[[]][]": False, "": False, '["]': True, '[{"a":{"b":[1,2]}},3]': True, "[}]": False, '[1,"a"],"': True, "{}": True, None: None,
    }
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    assert {r.t: r.e for r in rows.select("t", ends_with_first_value(F.col("t")).alias("e")).collect()} == texts
