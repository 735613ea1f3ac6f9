import json
from collections import Counter
from datetime import date, datetime, timezone
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from bindings import queries_ingest
from conftest import rows_of
from revstream.catalog import OBJECTS, crm_object
from revstream.operators.incremental import incremental_extract, wire_timestamp
from revstream.plans import monitor
from revstream.session import SHREDDING
from revstream.sources import landing
from revstream.sources.listing import folder_below, list_files
from revstream.streaming import ingest

RUN = datetime(2026, 4, 20, 12, tzinfo=timezone.utc)


def write(path, lines, name="a.json"):
    Path(path).mkdir(parents=True, exist_ok=True)
    (Path(path) / name).write_text("\n".join(x if isinstance(x, str) else json.dumps(x) for x in lines))


def test_ten_objects_with_modstamp():
    assert len(OBJECTS) == 10
    assert all("SystemModstamp" in o.extract_fields for o in OBJECTS.values())
    assert sum(o.clustered for o in OBJECTS.values()) == 5
    with pytest.raises(ValueError):
        crm_object("Invoice")


def test_wire_timestamp_format():
    assert wire_timestamp(datetime(2026, 4, 17)) == "2026-04-17T00:00:00.000+0000"


def test_account_line_loads_typed(spark, folder):
    line = {
        "Id": "001000000000001AAA", "Name": "Acme", "AnnualRevenue": "5000000", "NumberOfEmployees": "250",
        "IsDeleted": "false", "CreatedDate": "2024-01-15T10:30:00.000+0000", "BillingLatitude": "",
        "SystemModstamp": "2024-01-15T10:30:00.000+0000", "_extract_timestamp": "2026-04-20T12:00:00+00:00",
        "_source_object": "Account",
    }
    write(folder, [line])
    row = landing.load_typed(landing.scan_ndjson(spark, folder, "Account"), "Account", RUN).first()
    assert (row.id, int(row.annualrevenue), row.numberofemployees) == ("001000000000001AAA", 5000000, 250)
    assert row.isdeleted is False and row.billinglatitude is None and row._bad_fields is None
    assert row.createddate == datetime(2024, 1, 15, 10, 30)
    assert row._extract_timestamp == datetime(2026, 4, 20, 12) and row._load_timestamp == datetime(2026, 4, 20, 12)
    assert row._file_name.endswith("a.json") and row.rating is None


def test_missing_keys_and_null_texts(spark, folder):
    write(folder, [{"Id": "u1", "Name": "None", "Email": "null", "Title": "", "IsActive": "true"}])
    row = landing.load_typed(landing.scan_ndjson(spark, folder, "User"), "User", RUN).first()
    assert (row.id, row.name, row.email, row.title, row.isactive, row.isdeleted) == ("u1", None, None, None, True, None)


def test_bad_rows_do_not_cost_the_file(spark, folder):
    write(folder, [{"Id": "1", "Amount": "10"}, "{broken", {"Id": "2", "Amount": "ten", "CloseDate": "2026-13-01"}])
    loaded = landing.load_typed(landing.scan_ndjson(spark, folder, "Opportunity"), "Opportunity", RUN)
    good, bad = landing.split_bad_rows(loaded)
    assert [r.id for r in good.collect()] == ["1"]
    assert sorted((r.id or "", r._bad_fields) for r in bad.collect()) == [("", "_corrupt_record"), ("2", "Amount,CloseDate")]


def test_new_field_reachable_in_raw_record(spark, folder):
    write(folder, [{"Id": "1", "Tier__c": {"level": 3}}])
    df = landing.scan_ndjson(spark, folder, "Account")
    got = df.select(
        landing.variant_extract(df, "raw_data", "$.Tier__c.level", "int"),
        landing.variant_extract(df, "raw_data", "$.nothing", "string"),
        landing.variant_extract(df, "raw_data", "$.Id", "int"),
    ).first()
    assert tuple(got) == (3, None, 1)


def test_csv_page_with_byte_order_mark(spark, folder):
    Path(folder).mkdir(parents=True)
    (Path(folder) / "p.csv").write_bytes("﻿Id,Name,Amount\n1,\"a, b\",5\n".encode())
    row = landing.scan_csv_pages(spark, folder, "Opportunity").first()
    assert (row.Id, row.Name, row.Amount, row.CloseDate) == ("1", "a, b", "5", None)


def test_landed_files_hold_at_most_50k_rows_and_explicit_nulls(spark, folder):
    df = spark.range(120_000).coalesce(1).select(F.col("id").alias("Id"), F.lit(None).cast("string").alias("Name"))
    landing.land_ndjson(df, folder, "Lead", RUN)
    files = sorted(Path(folder, "lead", "date=2026-04-20").glob("*.json"))
    assert [sum(1 for _ in f.open()) for f in files] == [50_000, 50_000, 20_000]
    first = json.loads(files[1].open().readline())
    assert first["Name"] is None and first["_row_ordinal"] == "1" and first["_source_object"] == "Lead"
    assert first["_extract_timestamp"] == "2026-04-20T12:00:00+00:00"


def test_partition_scan_reads_only_the_asked_dates(spark, folder):
    for day in (1, 2, 3):
        write(f"{folder}/task/date=2026-01-0{day}", [{"Id": str(day)}])
    df = landing.land_partition_scan(spark, folder, "Task", "2026-01-02", "2026-01-02")
    assert [r.Id for r in df.collect()] == ["2"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan


def test_auto_ingest_loads_each_file_once(spark, folder):
    table, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    modified = "2026-01-05T00:00:00.000+0000"
    write(f"{folder}/land/user/date=2026-01-01", [{"Id": "1", "SystemModstamp": modified}, {"Id": "x", "IsActive": "perhaps"}])
    for expected in (["1"], ["1"]):
        ingest.auto_ingest(spark, f"{folder}/land", "User", table, checkpoint, RUN)
        assert sorted(r.id for r in ingest.read_ingested(spark, table).collect()) == expected
    write(f"{folder}/land/user/date=2026-01-02", [{"Id": "2", "SystemModstamp": modified}], "b.json")
    ingest.auto_ingest(spark, f"{folder}/land", "User", table, checkpoint, RUN)
    assert sorted(r.id for r in ingest.read_ingested(spark, table).collect()) == ["1", "2"]
    assert [(r.id, r._bad_fields) for r in ingest.read_ingested(spark, table, bad=True).collect()] == [("x", "IsActive")]


def test_incremental_extract_pushes_the_watermark_to_the_scan(spark, folder):
    spark.range(10).selectExpr("id", "timestamp_ntz'2026-01-01 00:00:00' + make_interval(0,0,0,id) as systemmodstamp").write.parquet(folder)
    df = incremental_extract(spark.read.parquet(folder), "Account", datetime(2026, 1, 6))
    assert sorted(r.Id for r in df.collect()) == [5, 6, 7, 8, 9]
    assert "GreaterThanOrEqual(systemmodstamp" in df._jdf.queryExecution().executedPlan().toString()


def test_csv_pages_are_read_by_their_own_headers(spark, folder):
    Path(folder).mkdir(parents=True, exist_ok=True)
    pages = {
        "p1": "Id,Name,Amount\n1,a,10\n", "p2": "\ufeffName,Id\n\"b,\nb\",2\n", "p3": "Id,Unknown,Name\n3,x,c\n", "p4": "",
        "p5": "Id,Name,Amount\n5,e,50\n6\n", "p6": "Id,Name,Name\n7,first,last\n", "p7": "Id,Name,Amount\n",
    }
    for name, text in pages.items():
        (Path(folder) / f"{name}.csv").write_text(text)
    rows = landing.scan_csv_pages(spark, folder, "Opportunity").collect()
    assert sorted((r.Id, r.Name, r.Amount) for r in rows) == sorted(
        [("1", "a", "10"), ("2", "b,\nb", None), ("3", "c", None), ("5", "e", "50"), ("6", None, None), ("7", "last", None)], key=lambda r: r[0]
    )


def test_csv_folder_without_pages(spark, folder):
    Path(folder).mkdir(parents=True, exist_ok=True)
    (Path(folder) / "empty.csv").write_text("")
    assert landing.scan_csv_pages(spark, folder, "Opportunity").collect() == []


def land_users(folder, day, name, ids, bad=()):
    rows = [{"Id": str(i), "SystemModstamp": f"2026-0{1 + i % 3}-05T00:00:00.000+0000", "_row_ordinal": str(n + 1), "_extract_timestamp": f"2026-01-0{day}T00:00:00+00:00"} | ({"IsActive": "perhaps"} if i in bad else {}) for n, i in enumerate(ids)]
    write(f"{folder}/land/user/date=2026-01-0{day}", rows, name)


def test_ledger_holds_each_file_once(spark, folder):
    table, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    ingest_users = lambda **how: ingest.auto_ingest(spark, f"{folder}/land", "User", table, checkpoint, RUN, **how)
    land_users(folder, 1, "a.json", range(10), bad=(4, 7))
    land_users(folder, 1, "b.json", range(10, 15))
    ingest_users(files_per_trigger=1)
    land_users(folder, 2, "c.json", range(15, 18), bad=(16,))
    write(f"{folder}/land/user/date=2026-01-02", ["{broken"], "d.json")
    ingest_users()
    ledger = lambda: sorted((Path(r.file_name).name, r.row_count, r.error_count, r.first_error_line_number, r.first_error_column_name, r.batch_id) for r in ingest.read_ledger(spark, table).collect())
    want = [("a.json", 10, 2, 5, "IsActive"), ("b.json", 5, 0, None, None), ("c.json", 3, 1, 2, "IsActive"), ("d.json", 1, 1, None, "_corrupt_record")]
    before = ledger()
    assert [r[:5] for r in before] == want and [r[5] for r in before][2:] == [2, 2]
    loaded = lambda: sorted(int(r.id) for r in ingest.read_ingested(spark, table).collect())
    good = [i for i in range(18) if i not in (4, 7, 16)]
    assert loaded() == good and ingest.read_ingested(spark, table, bad=True).count() == 4
    # The last batch dies after its data was written: it comes again under its number, with a file more on disk.
    for name in ("2", ".2.crc"):
        Path(checkpoint.removeprefix("file:"), "commits", name).unlink(missing_ok=True)
    land_users(folder, 3, "e.json", [20])
    ingest_users()
    assert ledger()[:4] == before and loaded() == [*good, 20]
    files = landed_files(spark, folder)
    assert files.count() == 5
    state = monitor.pipe_status(files, ingest.read_ledger(spark, table), RUN).first()
    assert (state.pending, state.failed) == (0, 3)
    day = monitor.files_per_pipe_day(ingest.read_ledger(spark, table), RUN).first()
    assert (day.pipe_name, day.files_loaded, day.rows_loaded, day.errors) == ("User", 5, 20, 4)
    assert [Path(r.file_name).name for r in monitor.failed_files(ingest.read_ledger(spark, table), RUN).collect()] == ["a.json", "c.json", "d.json"]


def landed_files(spark, folder):
    return list_files(spark, f"{folder}/land/user", "*.json").select(F.lit("User").alias("pipe_name"), "file_name")


def test_rows_without_a_ledger_entry_are_not_read(spark, folder):
    """A batch that died between its rows and its ledger part does not count."""
    table, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    land_users(folder, 1, "a.json", range(4))
    ingest.auto_ingest(spark, f"{folder}/land", "User", table, checkpoint, RUN)
    half = spark.read.parquet(f"{table}/rows/batch_id=0")
    half.write.partitionBy("is_bad", "mod_month").parquet(f"{table}/rows/batch_id=1")
    assert ingest.read_ingested(spark, table).count() == 4
    since = ingest.read_ingested(spark, table, since=datetime(2026, 2, 1, tzinfo=timezone.utc))
    assert sorted(r.id for r in since.collect()) == ["1", "2"]
    plan = since._jdf.queryExecution().executedPlan().toString()
    assert "mod_month" in plan[plan.index("PartitionFilters"):].split("PushedFilters")[0]


def test_fold_leaves_few_files_and_the_same_rows(spark, folder):
    table, checkpoint = f"{folder}/table", f"{folder}/checkpoint"
    load = lambda: ingest.auto_ingest(spark, f"{folder}/land", "User", table, checkpoint, RUN)
    loaded = lambda: sorted(int(r.id) for r in ingest.read_ingested(spark, table).collect())
    months = [date(2026, m, 1) for m in (1, 2, 3)]
    files = lambda: Counter(r.mod_month for r in ingest.ingested_files(spark, table).collect())
    for k in range(4):
        land_users(folder, 1, f"{k}.json", range(10 * k, 10 * k + 9), bad=(10 * k + 4,))
        load()
    rows = [i for k in range(4) for i in range(10 * k, 10 * k + 9) if i % 10 != 4]
    assert ingest.fold_months(spark, table, min_files=4) == [] and set(files().values()) == {4}  # the newest batch does not count
    assert ingest.fold_months(spark, table, min_files=3) == months
    assert loaded() == rows and set(files().values()) == {2}
    ledger = ingest.read_ledger(spark, table)
    assert ledger.count() == 4 and ledger.schema.simpleString() == spark.createDataFrame([], ingest.LEDGER).schema.simpleString()
    assert ingest.read_ingested(spark, table, bad=True).count() == 4
    # The newest batch comes again with another file; two of its months are folded.
    for name in ("3", ".3.crc"):
        Path(checkpoint.removeprefix("file:"), "commits", name).unlink(missing_ok=True)
    land_users(folder, 2, "e.json", [100, 101, 102])
    load()
    land_users(folder, 2, "f.json", [201, 202])
    load()
    rows += [100, 101, 102, 201, 202]
    assert loaded() == sorted(rows)
    # A fold that died before its ledger part changes nothing, and its folder is taken over by the next.
    half = spark.read.parquet(f"{table}/rows/batch_id=0").filter("not is_bad")
    half.write.partitionBy("is_bad", "mod_month").parquet(f"{table}/rows/batch_id=-2")
    assert loaded() == sorted(rows)
    assert set(ingest.fold_months(spark, table, min_files=2)) == set(months) and loaded() == sorted(rows)
    assert max(files().values()) == 2 and ingest.fold_months(spark, table, min_files=2) == []
    since = ingest.read_ingested(spark, table, since=datetime(2026, 3, 1, tzinfo=timezone.utc))
    assert sorted(int(r.id) for r in since.collect()) == [i for i in sorted(rows) if i % 3 == 2]
    times = spark.read.parquet(f"{table}/rows/batch_id=-2").filter("mod_month = date'2026-02-01'").select("systemmodstamp").collect()
    assert times == sorted(times) and len(times) == sum(i % 3 == 1 for i in rows if i < 200)


def test_listing_reads_no_contents(spark, folder):
    land_users(folder, 1, "a.json", range(4))
    write(f"{folder}/land/lead/date=2026-01-01", ["{}"], "b.json")
    files = list_files(spark, f"{folder}/land").withColumn("table_name", folder_below(f"{folder}/land"))
    sizes = {r.table_name: (r.files, r.bytes) for r in files.groupBy("table_name").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes")).collect()}
    assert sizes["lead"] == (1, 2) and sizes["user"][0] == 1
    assert "content" not in files._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[-1]


def test_landing_packed_files_read_the_same_and_take_a_fraction_of_the_space(spark, folder):
    df = spark.range(20_000).coalesce(2).select(F.col("id").cast("string").alias("Id"), F.concat(F.lit("Lead "), "id").alias("Name"), F.lit(None).cast("string").alias("Company"))
    for root, how in (("plain", {}), ("packed", {"compression": "gzip"})):
        landing.land_ndjson(df, f"{folder}/{root}", "Lead", RUN, rows_per_file=6_000, **how)
    plain, packed = (list(Path(folder, root, "lead").rglob("part-*")) for root in ("plain", "packed"))
    assert len(packed) == len(plain) == 4 and all(f.name.endswith(".json.gz") for f in packed)
    assert 5 * sum(f.stat().st_size for f in packed) < sum(f.stat().st_size for f in plain)
    read = [landing.scan_ndjson(spark, f"{folder}/{root}/lead", "Lead").select("Id", "Name", "Company", "_row_ordinal", F.col("date").cast("string")) for root in ("plain", "packed")]
    assert rows_of(read[0]) == rows_of(read[1]) and read[1].count() == 20_000


def test_stream_upsert_query_lands_packed_files(spark, sf_dir, folder, monkeypatch):
    monkeypatch.setattr(queries_ingest, "scratch_dir", lambda spark, purpose: f"{folder}/{purpose}")
    got = queries_ingest.QUERIES["stream_upsert"](spark, sf_dir)
    assert got.count() == spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    assert {f.suffix for f in Path(folder, "landing").rglob("part-*")} == {".gz"}


def test_loads_and_folds_keep_records_whole(spark, folder):
    """A variant taken apart into columns costs three times the time to write and to read whole."""
    table, shredding = f"{folder}/table", {key: spark.conf.get(key) for key in SHREDDING}
    for k in range(3):
        land_users(folder, 1, f"{k}.json", range(10 * k, 10 * k + 9))
        ingest.auto_ingest(spark, f"{folder}/land", "User", table, f"{folder}/checkpoint", RUN)
    before = sorted(r.raw for r in ingest.read_ingested(spark, table).select(F.to_json("raw_data").alias("raw")).collect())
    assert len(ingest.fold_months(spark, table, min_files=2)) == 3
    assert sorted(r.raw for r in ingest.read_ingested(spark, table).select(F.to_json("raw_data").alias("raw")).collect()) == before
    for batch in (0, 2, -1):
        files = list(Path(table.removeprefix("file:")).glob(f"rows/batch_id={batch}/**/*.parquet"))
        assert files
        for file in files:
            assert {f.name for f in pq.read_schema(file).field("raw_data").type} == {"metadata", "value"}
    assert {key: spark.conf.get(key) for key in SHREDDING} == shredding
