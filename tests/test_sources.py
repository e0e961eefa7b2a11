import os
from decimal import Decimal

import pytest

from tillweave.operators import quality
from tillweave.sources import documents, masters, tables


def write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_notice_files(spark, folder):
    write(f"{folder}/a.csv", 'notice_id,portal_id,title,body,estimated_value,closing_date,extra,published_at\n'
                             'N1,P1,"Road, ""north""","line 1\nline 2",100.5,12-03-2024,x,2024-03-01T10:00:00\n')
    write(f"{folder}/b.csv", 'notice_id,portal_id,title,body,estimated_value,closing_date,extra,published_at\nN2,P2,,,n/a,,y,\n')
    notices = documents.read_notices(spark, folder)
    docs = {r.doc_id: r for r in documents.as_documents(notices).collect()}
    assert docs["N1"].text == 'Road, "north" line 1\nline 2' and docs["N1"].published_at.hour == 10
    assert docs["N2"].text.strip() == "" and docs["N2"].published_at is None
    assert {r.notice_id: r.estimated_value for r in notices.collect()} == {"N1": 100.5, "N2": None}
    write(f"{folder}/pairs.txt", "notice_id_a,notice_id_b,label\nN1,N2,different\n")
    assert [tuple(r) for r in documents.read_pairs(spark, f"{folder}/pairs.txt").collect()] == [("N1", "N2", "different")]


def test_one_large_notice_file_gives_several_tasks(spark, folder):
    """Records longer than a block, quotes and breaks at block ends, two files of different column order."""
    import csv
    import random
    draw = random.Random(4)
    pieces = ['a "quoted" word', "line\nbreak", '""', "\n\n", "comma, semicolon;", "été", '"', "\r\n", "plain words " * 5]
    rows = {f"N{i}": ("".join(draw.choice(pieces) for _ in range(draw.randrange(0, 60))), draw.choice(["", "title", 'x "y"\nz'])) for i in range(300)}
    for name, ids, order in (("a.csv", list(rows)[:200], [0, 1, 2]), ("b.csv", list(rows)[200:], [2, 0, 1])):
        with open(f"{folder}/{name}", "w", encoding="utf-8", newline="") as out:
            write_row = csv.writer(out, quoting=csv.QUOTE_ALL, lineterminator="\n").writerow
            write_row([("notice_id", "body", "title")[k] for k in order])
            for i in ids:
                write_row([(i, *rows[i])[k] for k in order])
    old = {key: spark.conf.get(key) for key in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    for key in old:
        spark.conf.set(key, "2k")
    try:
        assert spark.read.option("lineSep", "\n").text(f"{folder}/a.csv").rdd.getNumPartitions() > 10
        got = documents.read_notices(spark, folder).collect()
    finally:
        for key, value in old.items():
            spark.conf.set(key, value)
    assert len(got) == 300 and {r.portal_id for r in got} == {None}
    assert {r.notice_id: (r.body or "", r.title or "") for r in got} == rows


def test_masters_and_finance(spark, folder):
    write(f"{folder}/stores.csv", "store_id,store_name,address_line,city,state,region,floor_area_sqft,opened_on\n"
                                  'S01,One,"1, Road",X,Y,South,10,2011-01-01\n')
    write(f"{folder}/product_categories.csv", "category_id,category_name,department,gst_rate\nC01,Food,F,0.18\n")
    write(f"{folder}/products.csv", "product_sk,product_code,product_name,category_id,brand,pack_size,uom,valid_from,valid_to,is_current\n"
                                    "1,A,Soap,C01,b,1kg,EA,2019-01-01,2024-05-31,false\n2,A,Lamp,C09,b,1,EA,2024-06-01,,true\n")
    write(f"{folder}/price_revisions.csv", "revision_id,product_sk,mrp,selling_price,effective_from,effective_to\n"
                                           "1,1,10.00,9.50,2022-01-01,9999-12-31\n")
    loaded = masters.load_masters(spark, folder, f"{folder}/out")
    assert str(loaded["products"].where("product_sk = 2").first().valid_to) == "9999-12-31"
    assert loaded["product_categories"].first().gst_rate == Decimal("0.180")
    report = {r.check: r.violations for r in quality.interval_quality(
        loaded["products"], loaded["price_revisions"], loaded["product_categories"]).collect()}
    assert report["product category known"] == 1 and report["validity overlap"] == 0 and report["validity gap"] == 0
    write(f"{folder}/finance.csv", "month,closed_on,revenue_inr,signed_off_by\n2024-01,2024-02-09,38446071.33,x\n2024-12,2025-01-09,50745209.0,x\n")
    assert [r.revenue_inr for r in masters.read_finance(spark, f"{folder}/finance.csv").collect()] == [Decimal("38446071.33"), Decimal("50745209.00")]
    write(f"{folder}/finance2.csv", "month,revenue_inr,closed_on,signed_off_by\n2024-01,1,2024-02-09,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        masters.read_finance(spark, f"{folder}/finance2.csv").collect()


def test_jdbc_scan_is_split_into_ranges():
    options = masters.jdbc_options("jdbc:postgresql://db/x", "public.products", key="product_sk", bounds=(1, 100), partitions=4, user="u")
    assert options["partitionColumn"] == "product_sk" and options["numPartitions"] == "4" and options["user"] == "u"
    assert "partitionColumn" not in masters.jdbc_options("jdbc:postgresql://db/x", "stores")


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_table_updates(spark, folder):
    path, schema = f"{folder}/t", "k int, p int, v string"
    tables.replace(spark.createDataFrame([(1, 0, "a"), (1, 1, "b")], schema), path)
    more = spark.createDataFrame([(1, 1, "x"), (2, 0, "c")], schema)
    made = [tables.append_absent(more, path, ["k", "p"]) for _ in range(3)]
    assert made == [2, 2, 2] and rows_of(tables.read_table(spark, path)) == [(1, 0, "a"), (1, 1, "b"), (2, 0, "c")]
    for _ in range(2):
        tables.upsert_table(more, path, ["k", "p"])
    assert rows_of(tables.read_table(spark, path)) == [(1, 0, "a"), (1, 1, "x"), (2, 0, "c")]


def test_a_reader_keeps_its_version(spark, folder):
    path = f"{folder}/t"
    data = lambda: {name for name in os.listdir(path) if name.startswith("data-")}
    with pytest.raises(FileNotFoundError):
        tables.read_table(spark, path)
    tables.replace(spark.range(3), path)
    first = tables.read_table(spark, path)
    before = data()
    assert tables.replace(first.selectExpr("id + 10 AS id"), path) == 2
    assert len(data() - before) == 1 and before <= data()
    assert rows_of(first) == [(0,), (1,), (2,)] == rows_of(tables.read_table(spark, path, 1))
    assert rows_of(tables.read_table(spark, path)) == [(10,), (11,), (12,)]
    before = data()
    assert tables.append(spark.range(1), path) == 3 and len(data() - before) == 1
    assert rows_of(tables.read_table(spark, path)) == [(0,), (10,), (11,), (12,)]
    tables.expire(spark, path, keep=2)
    assert tables.versions(spark, path) == [2, 3] and len(data()) == 2
    assert rows_of(tables.read_table(spark, path, 2)) == [(10,), (11,), (12,)]
    with pytest.raises(tables.VersionConflict):
        tables._commit(spark, path, 3, [])
    assert tables.versions(spark, path) == [2, 3] and len(tables.folders(spark, path, 3)) == 2


def test_csv_sink(spark, folder):
    tables.write_csv(spark.createDataFrame([(1, "a,b")], "n int, t string"), f"{folder}/out")
    tables.write_csv(spark.createDataFrame([(2, "c")], "n int, t string"), f"{folder}/out")
    parts = [f for f in os.listdir(f"{folder}/out") if f.endswith(".csv")]
    lines = [line for p in parts for line in open(f"{folder}/out/{p}").read().split()]
    assert set(lines) == {"n,t", "2,c"} and lines.count("2,c") == 1


def test_plan_evidence_names_scan_filters_and_joins(spark, folder):
    path = f"{folder}/t"
    spark.createDataFrame([(1, "a")], "k int, v string").write.parquet(path)
    df = spark.read.parquet(path)
    joined = df.where("k > 3").select("k").join(df.withColumnRenamed("v", "w"), "k").groupBy("w").count()
    evidence = tables.plan_evidence(joined)
    assert any("PushedFilters" in e and "GreaterThan(k,3)" in e for e in evidence)
    assert any("Join" in e for e in evidence) and any("HashAggregate" in e for e in evidence)
