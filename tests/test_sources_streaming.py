import tempfile
from datetime import datetime

from pyspark.sql import functions as F

from migratrace.registry.tickets import raw_tickets
from migratrace.operators.classify import classify
from migratrace.session import shared_folder
from migratrace.sources import tables as S
from migratrace.streaming.live import label_stream
from tests.conftest import SF


def test_csv_header_copies_and_missing_texts(spark):
    folder = tempfile.mkdtemp()
    path = f"{folder}/My.Export.CSV"
    with open(path, "w", encoding="utf-8") as f:
        f.write('Number,Title,Number,Area1,Area2\n1,"a ""quoted""\nline",x,NaN,2\n2,,y,N/A,3\n')
    df = S.read_export(spark, path)
    assert df.columns == ["Number", "Title", "Number.1", "Area1", "Area2"]
    rows = df.orderBy("Number").collect()
    assert rows[0]["Title"] == 'a "quoted"\nline' and rows[0]["Area1"] is None and rows[1]["Title"] is None and rows[1]["Area1"] is None
    assert S.dataset_name(path) == "My.Export"


def test_header_names_are_those_of_the_file(spark):
    folder = tempfile.mkdtemp()
    for i, (line, names) in enumerate(
        [
            ("Number,Severity1,Severity2,Title", ["Number", "Severity1", "Severity2", "Title"]),
            ("Number,Area0,Area0,area0", ["Number", "Area0", "Area0.1", "area0.2"]),
            ("a,a,a.1,,x y", ["a", "a.2", "a.1", "_c3", "x y"]),
        ]
    ):
        path = f"{folder}/{i}.csv"
        with open(path, "w", encoding="utf-8") as f:
            f.write(line + "\n" + ",".join(str(k) for k in range(len(names))) + "\n")
        df = S.read_export(spark, path)
        assert df.columns == names
        assert [list(r) for r in df.collect()] == [[str(k) for k in range(len(names))]]


def test_texts_survive_a_csv_export(spark):
    texts = ["a\rb", "a\r\nb\n", "  both ends ", 'say "x", \\"', "\r", ",", None, "plain"]
    path = f"{tempfile.mkdtemp()}/t.csv"
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    S.export_csv(rows, path, quote_all=True)
    back = S.read_export(spark, path, line_end="\n")
    assert [r["text"] for r in back.orderBy(F.col("i").cast("int")).collect()] == texts


def test_stage_replacement_keeps_other_datasets(spark):
    base = tempfile.mkdtemp()
    S.write_stage(spark.range(3), base, "catalog", "b")
    S.write_stage(spark.range(5), base, "catalog", "a")
    S.write_stage(spark.range(1), base, "catalog", "b")
    assert [r[0] for r in S.list_datasets(spark, base).collect()] == ["a", "b"]
    assert S.read_stage(spark, base, "catalog", "a").count() == 5 and S.read_stage(spark, base, "catalog", "b").count() == 1


def test_missing_summary_is_empty(spark):
    assert S.read_summary(spark, tempfile.mkdtemp() + "/none").count() == 0


def test_shared_folder_is_the_one_of_the_session(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")


def test_labels_on_a_stream_equal_the_batch(spark):
    folder = tempfile.mkdtemp()
    raw = raw_tickets(spark, SF, texts=True)
    raw.write.parquet(f"{folder}/in")
    start = datetime(2024, 1, 1)
    stream = label_stream(spark.readStream.schema(raw.schema).parquet(f"{folder}/in"), start)
    query = (
        stream.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/state")
        .trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert query.exception() is None
    got = spark.read.parquet(f"{folder}/out")
    want = label_stream(spark.read.parquet(f"{folder}/in"), start)
    assert got.count() == want.count() > 0
    assert got.exceptAll(want.select(*got.columns)).count() == 0
    labels = classify(raw).groupBy("System_Type").count().collect()
    assert sorted(map(tuple, labels)) == sorted(map(tuple, got.groupBy("System_Type").count().collect()))


def test_text_tickets_are_exported_compressed_by_many_tasks(spark, monkeypatch, tmp_path):
    from pathlib import Path

    from migratrace.registry import q_sources

    monkeypatch.setattr(q_sources, "_folder", lambda spark: str(tmp_path))
    back = q_sources.csv_export(spark, "/root/testdata/sf0.001")
    files = [f for f in Path(tmp_path, "tickets.csv").iterdir() if f.name.startswith("part-")]
    assert len(files) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert all(f.name.endswith(".csv.gz") for f in files)
    assert back.count() == spark.read.parquet("/root/testdata/sf0.001/orders.parquet").count()
