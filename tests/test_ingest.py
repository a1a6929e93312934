import datetime as dt
import json
import pathlib
import random
import time
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from basketlake.functions import parsers
from basketlake.schemas import CSV_COLUMNS, RAW_COLUMNS
from basketlake.shared import cut_lineage
from basketlake.sources import parts, readers, sinks


def model_int(v):
    try:
        return int(float(v)) if v else None
    except (ValueError, OverflowError):
        return None


def model_date(v):
    for fmt in ("%m/%d/%Y %H:%M", "%m/%d/%Y %H:%M:%S"):
        try:
            return dt.datetime.strptime(v, fmt)
        except ValueError:
            pass
    return None


def test_numbers_follow_a_plain_model(spark):
    rnd = random.Random(7)
    texts = ["", "abc", "17850.0", "-3.9", "1e3", " 12 ", "+5", ".5", "5.", "-", "1.2.3", "NaN", "12d", None]
    texts += [str(rnd.uniform(-1e6, 1e6)) for _ in range(50)] + [str(rnd.randint(-(10**6), 10**6)) for _ in range(50)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    out = df.select("t", parsers.parse_int(F.col("t")), parsers.parse_float(F.col("t"))).collect()
    for text, as_int, as_float in out:
        assert as_int == model_int(text), text
        plain = text not in (None, "", "NaN") and model_int(text) is not None
        assert as_float == (float(text) if plain else None), text


def test_big_customer_number_stays_exact(spark):
    big = str(2**53 + 1)
    assert spark.range(1).select(parsers.parse_int(F.lit(big), "bigint")).first()[0] == 2**53 + 1


def test_dates_follow_a_plain_model(spark):
    rnd = random.Random(11)
    texts = ["12/1/2010 8:26", "12/01/2010 08:26:30", "13/1/2010 8:26", "2/30/2011 1:00", "2010-12-01", "", "1/1/2011 24:00", "1/1/2011 1:5"]
    texts += [f"{rnd.randint(1, 14)}/{rnd.randint(1, 32)}/{rnd.randint(1990, 2030)} {rnd.randint(0, 25)}:{rnd.randint(0, 61):02d}" for _ in range(200)]
    # A time inside a daylight saving gap keeps its wall clock, whatever the session zone.
    texts.append("3/13/2011 2:30")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([(t,) for t in texts], "t string")
        for text, got in df.select("t", parsers.parse_invoice_date(F.col("t"))).collect():
            assert got == model_date(text), text
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_strip_excel_eq(spark):
    cases = {"=85123A": "85123A", " = 7 ": "7", "nan": None, "NaN": None, "=": None, "": None, "x=1": "x=1", "==2": "=2"}
    df = spark.createDataFrame([(k,) for k in cases], "t string")
    assert {r[0]: r[1] for r in df.select("t", parsers.strip_excel_eq(F.col("t"))).collect()} == cases


CSV = (
    "InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n"
    '536365,85123A,"CAFÉ, £ ""SET""",6,12/1/2010 8:26,2.55,17850.0,United Kingdom\n'
    "C536366,71053,,-1,bad date,abc,,\n"
)


def test_csv_latin1(spark, tmp_path):
    (tmp_path / "data.csv").write_bytes(CSV.encode("latin-1"))
    got = {r.invoice_no: r for r in readers.read_transactions_csv(spark, str(tmp_path)).collect()}
    a, b = got["536365"], got["C536366"]
    assert a.description == 'CAFÉ, £ "SET"' and a.quantity == 6 and str(a.unit_price) == "2.55"
    assert a.invoice_date == dt.datetime(2010, 12, 1, 8, 26) and a.customer_id == "17850.0"
    assert (b.quantity, b.invoice_date, b.unit_price, b.customer_id) == (-1, None, None, None)
    excel = {r.invoice_no: r.customer_id for r in readers.read_transactions_csv(spark, str(tmp_path), excel=True).collect()}
    assert excel["536365"] == "17850"


def test_rename_by_position_and_name(spark):
    df = spark.createDataFrame([tuple("abcdefgh")], [f"h{i}" for i in range(8)])
    assert readers.rename_by_position(df).columns == RAW_COLUMNS
    named = spark.createDataFrame([tuple("hgfedcbax")], CSV_COLUMNS[::-1] + ["extra"])
    assert tuple(readers.rename_by_name(named).first()) == tuple("abcdefgh")


def test_json_array(spark):
    item = dict(zip(CSV_COLUMNS, ["1", "A", "d", "2", "12/1/2010 8:26", "1.5", "", "France"]))
    docs = spark.createDataFrame([(json.dumps([item, {**item, "InvoiceNo": "2"}]),), ("[]",)], "payload string")
    out = readers.read_transactions_json(docs).collect()
    assert sorted(r.invoice_no for r in out) == ["1", "2"] and out[0].quantity == 2


def test_overwrite_append_and_counts(spark, raw, tmp_path):
    path = str(tmp_path / "t")
    assert sinks.load_raw_overwrite(raw, path) == raw.count()
    assert sinks.load_raw_append(raw.limit(3), path) == 3
    assert readers.read_table(spark, path).count() == raw.count() + 3
    assert sinks.load_raw_overwrite(raw.limit(2), path) == 2
    assert readers.read_table(spark, path).count() == 2
    assert sinks.table_exists(spark, path) and not sinks.table_exists(spark, str(tmp_path / "none"))


def test_partitioned_overwrite_keeps_untouched_months(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "v int, m string")
    sinks.write_table(df, path, partition_by="m", cluster=True)
    sinks.write_table(spark.createDataFrame([(9, "b")], "v int, m string"), path, partition_by="m", only_touched=True)
    assert sorted(tuple(r) for r in sinks.read_table(spark, path).collect()) == [(1, "a"), (9, "b")]


def test_upsert_against_a_dict_with_a_hot_key(spark, tmp_path):
    rnd = random.Random(3)
    path = str(tmp_path / "kv")
    have: dict = {}
    for step in range(4):
        # A third of all updates hit one key.
        batch = [(1 if rnd.random() < 0.34 else rnd.randint(1, 40), rnd.randint(0, 999), step * 1000 + i) for i in range(300)]
        sinks.upsert_keyed(spark, path, spark.createDataFrame(batch, "k int, v int, at int"), ["k"], ["at"])
        for k, v, at in batch:
            have[k] = (v, at)
    assert {r.k: (r.v, r.at) for r in sinks.read_table(spark, path).collect()} == have
    n = sinks.insert_if_absent(spark, path, spark.createDataFrame([(1, -1, -1), (77, -1, -1), (77, -1, -1)], "k int, v int, at int"), ["k"])
    assert n == len(have) + 1
    assert {r.k: r.v for r in sinks.read_table(spark, path).collect()} == {**{k: v for k, (v, _) in have.items()}, 77: -1}


def test_upsert_rewrites_only_touched_partitions(spark, tmp_path):
    path = str(tmp_path / "kv")
    first = spark.createDataFrame([(k, 0, f"m{k % 5}") for k in range(50)], "k int, v int, m string")
    sinks.upsert_keyed(spark, path, first, ["k"], partition_by="m")
    at = tmp_path / "kv" / "snapshot-00000001"
    before = {f: (at / f).stat().st_mtime_ns for f in ("m=m0", "m=m3")}
    sinks.upsert_keyed(spark, path, spark.createDataFrame([(3, 7, "m3"), (103, 8, "m3")], "k int, v int, m string"), ["k"], partition_by="m")
    got = {r.k: r.v for r in sinks.read_table(spark, path).collect()}
    assert got == {**{k: 0 for k in range(50)}, 3: 7, 103: 8}
    after = {f: (at / f).stat().st_mtime_ns for f in before}
    assert after["m=m0"] == before["m=m0"] and after["m=m3"] != before["m=m3"]


def test_failed_overwrite_keeps_the_old_table(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5), path)
    with pytest.raises(Exception):
        sinks.write_table(spark.range(5).selectExpr("id div (id - 3) as id"), path)
    assert sinks.read_table(spark, path).count() == 5
    # A table may be rewritten from itself.
    assert sinks.write_table(sinks.read_table(spark, path).where("id > 1"), path) == 3
    assert sinks.read_table(spark, path).count() == 3


def test_replacing_a_table_moves_no_file(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(5), path)
    reader = sinks.read_table(spark, path)  # has listed the files of the first snapshot
    first = sorted(p.name for p in (tmp_path / "t" / "snapshot-00000001").iterdir())
    (tmp_path / "t" / "snapshot-00000002").mkdir()  # left by a job that broke off
    assert sinks.current(spark, path).endswith("snapshot-00000001")
    sinks.write_table(spark.range(7), path)
    assert reader.count() == 5 and sinks.read_table(spark, path).count() == 7
    assert sorted(p.name for p in (tmp_path / "t" / "snapshot-00000001").iterdir()) == first
    sinks.write_table(spark.range(9), path)
    assert sorted(p.name for p in (tmp_path / "t").iterdir()) == ["snapshot-00000003", "snapshot-00000004"]
    assert sinks.read_table(spark, path, "id bigint").count() == 9
    spark.range(3).write.parquet(str(tmp_path / "plain"))
    assert readers.read_table(spark, str(tmp_path / "plain")).count() == 3


def files_of(folder):
    return {str(p.relative_to(folder)): p.stat().st_mtime_ns for p in folder.rglob("*.parquet")}


def test_a_broken_generation_of_an_untouched_bucket_stays_unread(spark, tmp_path):
    path, schema = str(tmp_path / "kv"), "k int, v int"
    sinks.upsert_keyed(spark, path, spark.createDataFrame([(k, 0) for k in range(200)], schema), ["k"], buckets=4)
    sinks.upsert_keyed(spark, path, spark.createDataFrame([(7, 1)], schema), ["k"])
    touched = next((tmp_path / "kv" / "buckets-4").glob("bucket=*/generation=2")).parent.name
    other = next(b for b in (f"bucket={i}" for i in range(4)) if b != touched)
    spark.createDataFrame([(7, 9)], schema).write.parquet(str(tmp_path / "kv" / "buckets-4" / other / "generation=3"))
    sinks.upsert_keyed(spark, path, spark.createDataFrame([(7, 2)], schema), ["k"])
    assert {r.k: r.v for r in sinks.read_table(spark, path).collect()} == {**{k: 0 for k in range(200)}, 7: 2}


def test_bucket_upsert_leaves_the_files_of_other_buckets(spark, tmp_path):
    path, schema = str(tmp_path / "kv"), "k int, v int, at int"
    start = [(k, 0, 0) for k in range(2000)]
    assert sinks.upsert_keyed(spark, path, spark.createDataFrame(start, schema), ["k"], buckets=32) == 2000
    before = files_of(tmp_path / "kv")
    sinks.upsert_keyed(spark, path, spark.createDataFrame([(7, 1, 1), (7, 2, 2), (5000, 3, 1)], schema), ["k"], ["at"])
    after = files_of(tmp_path / "kv")
    assert {f: t for f, t in after.items() if f in before} == before  # nothing was written over
    new = {f.split("/")[1] for f in after if f not in before}
    assert 1 <= len(new) <= 2
    want = {**{k: 0 for k in range(2000)}, 7: 2, 5000: 3}
    assert {r.k: r.v for r in sinks.read_table(spark, path).collect()} == want
    # A generation without its mark is one a broken job left: it is not read, nor is its number used again.
    bucket = next(iter(new))
    broken = tmp_path / "kv" / "buckets-32" / bucket / "generation=3"
    spark.createDataFrame([(7, 9, 9)], schema).write.parquet(str(broken))
    assert {r.k: r.v for r in sinks.read_table(spark, path).collect()} == want
    for v in (4, 5, 6):
        sinks.upsert_keyed(spark, path, spark.createDataFrame([(7, v, v)], schema), ["k"])
    assert {r.k: r.v for r in sinks.read_table(spark, path).collect()} == {**want, 7: 6}
    with pytest.raises(ValueError, match="32 buckets"):
        sinks.upsert_keyed(spark, path, spark.createDataFrame([(7, 9, 9)], schema), ["k"], buckets=16)


def test_bucket_upsert_against_a_dict_with_a_hot_key(spark, tmp_path):
    rnd, path, have = random.Random(4), str(tmp_path / "kv"), {}
    for step in range(3):
        batch = [(1 if rnd.random() < 0.34 else rnd.randint(1, 40), rnd.randint(0, 999), step * 1000 + i) for i in range(300)]
        sinks.upsert_keyed(spark, path, spark.createDataFrame(batch, "k int, v int, at int"), ["k"], ["at"], buckets=4)
        have |= {k: (v, at) for k, v, at in batch}
    assert {r.k: (r.v, r.at) for r in sinks.read_table(spark, path).collect()} == have


def test_csv_columns_are_found_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text("Country,More,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,InvoiceNo\nFrance,x,85123A,HEART,6,12/1/2010 8:26,2.55,17850,536365\n", encoding="latin-1")
    row = readers.read_transactions_csv(spark, str(tmp_path / "a.csv")).first()
    assert (row.invoice_no, row.country, row.stock_code, row.quantity, row.customer_id) == ("536365", "France", "85123A", 6, "17850")
    (tmp_path / "b.csv").write_text("InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country,More,\n536366,1,HEART,6,12/1/2010 8:26,2.55,17850,Spain,x,z\n", encoding="latin-1")
    assert sorted((r.invoice_no, r.stock_code, r.country) for r in readers.read_transactions_csv(spark, str(tmp_path)).collect()) == [("536365", "85123A", "France"), ("536366", "1", "Spain")]
    (tmp_path / "c.csv").write_text("InvoiceNo,StockCode\n1,2\n", encoding="latin-1")
    with pytest.raises(ValueError, match="c.csv: no column .*Country"):
        readers.read_transactions_csv(spark, str(tmp_path))


def test_csv_records_over_several_lines(spark, tmp_path):
    import gzip

    body = 'InvoiceNo,StockCode,Description,Quantity,InvoiceDate,UnitPrice,CustomerID,Country\n1,A,"two\nlines, ""quoted""",6,12/1/2010 8:26,2.55,17850,France\n2,B,one line,1,12/1/2010 8:26,1.00,,France\n'
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "a.csv").write_bytes(b"\xef\xbb\xbf" + body.encode("latin-1"))
    (tmp_path / "d" / "b.csv.gz").write_bytes(gzip.compress(body.replace("InvoiceNo,StockCode", "StockCode,InvoiceNo").encode("latin-1")))
    (tmp_path / "d" / "empty.csv").write_bytes(b"")
    (tmp_path / "d" / "_hidden.csv").write_bytes(b"x")
    got = sorted((r.invoice_no, r.stock_code, r.description) for r in readers.read_transactions_csv(spark, str(tmp_path / "d")).collect())
    assert got == sorted([("1", "A", 'two\nlines, "quoted"'), ("2", "B", "one line"), ("A", "1", 'two\nlines, "quoted"'), ("B", "2", "one line")])
    assert len(readers.read_transactions_csv(spark, str(tmp_path / "d" / "*.gz")).collect()) == 2
    (tmp_path / "none").mkdir()
    assert readers.read_transactions_csv(spark, str(tmp_path / "none")).count() == 0


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    files = lambda: {f for d in folders for f in pathlib.Path(str(d)).rglob("shuffle_*")}
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, said = files(), spark.conf.get(setting)
    sums = lambda: spark.range(4000).withColumn("k", F.col("id") % 100).groupBy("k").agg(F.sum("id").alias("s"))
    with ThreadPoolExecutor(3) as pool:
        todo = [pool.submit(inheritable_thread_target(spark)(sinks.write_table), sums(), str(tmp_path / f"t{i}"), partition_by="k", cluster=True) for i in range(3)]
        assert [t.result() for t in todo] == [100] * 3
    parts.write(sums(), str(tmp_path / "p"), 0, ["k"])
    cut = cut_lineage(sums())
    assert spark.conf.get(setting) == said
    for _ in range(50):
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before and cut.count() == 100
