import io
import zipfile

import pytest
from pyspark.sql import functions as F

from tablewright.sources import export as E
from tablewright.sources import files as R


def test_dictionary_folder(spark, tmp_path):
    bank = tmp_path / "bank"
    bank.mkdir()
    (bank / "choices.txt").write_text("1,Danske\n2, DNB, Lietuva\n", "utf-8")
    (bank / "aliases.txt").write_text("{bank}\n    {bank} bankas\n\n    bankas {bank}\nDanske\nDNB\n  dė en bė  ", "utf-8")
    (bank / "missing.txt").write_text("swed\n\nseb \n", "utf-8")
    (tmp_path / "kind").mkdir()
    (tmp_path / "kind" / "choices.txt").write_text("1,UAB", "utf-8")
    choices, aliases = R.load_dictionary(spark, str(tmp_path))
    assert sorted((r.dictionary, r.id, r.name) for r in choices.collect()) == [
        ("bank", 1, "Danske"), ("bank", 2, "DNB, Lietuva"), ("kind", 1, "UAB")]
    assert [(r.target, r.alias) for r in aliases.orderBy("pos").collect()] == [
        ("{bank}", "{bank} bankas"), ("{bank}", "bankas {bank}"), ("Danske", None), ("DNB", "dė en bė")]
    assert sorted(r.mention for r in R.load_missing(spark, str(tmp_path)).collect()) == ["seb", "swed"]


def test_malformed_choice_names_file_and_line(spark, tmp_path):
    (tmp_path / "bank").mkdir()
    (tmp_path / "bank" / "choices.txt").write_text("1,Danske\nDNB\n", "utf-8")
    with pytest.raises(Exception, match=r"malformed choice:.*choices\.txt:2:DNB"):
        R.load_choices(spark, str(tmp_path)).collect()


def test_csv_row_numbers_over_files(spark, tmp_path):
    for part in range(3):
        body = "".join(f"{part * 10 + i};v{i}\n" for i in range(10))
        (tmp_path / f"part-{part}.csv").write_text("n;v\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32")
    try:
        rows = R.read_keyed_csv(spark, str(tmp_path), ";", schema="n int, v string").collect()
        first = R.read_keyed_csv(spark, str(tmp_path), ";", limit=4, schema="n int, v string").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert sorted((r.key, r.n) for r in rows) == [(i + 1, i) for i in range(30)]
    assert sorted(r.n for r in first) == [0, 1, 2, 3]


def test_csv_key_uses_derived_columns(spark, tmp_path):
    (tmp_path / "q.csv").write_text("ID;T\n1;a\n2;b\n")
    rows = R.read_keyed_csv(spark, str(tmp_path / "q.csv"), ";", key="url", derived={"url": F.concat(F.lit("u"), "ID")})
    assert sorted(map(tuple, rows.collect())) == [("u1", "1", "a"), ("u2", "2", "b")] and rows.columns == ["key", "ID", "T"]


def test_legacy_report(spark, tmp_path):
    lines = ["antraštė"] * 2 + ["100; 7;1234,5; 0,25;Žąsis", "101;8;;2;Ė", ""]
    data = "\r\n".join(lines).encode("iso-8859-4")
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w") as archive:
        archive.writestr("DATA.CSV", data)
    (tmp_path / "a.zip").write_bytes(packed.getvalue())
    names = {"regnr": "string", "kodas": "bigint", "alga": "double", "autorine": "double", "name": "string"}
    rows = R.read_legacy_report(spark, str(tmp_path / "a.zip"), 2, names, "kodas", member="DATA.CSV").orderBy("key").collect()
    assert [(r.key, r.regnr, r.alga, r.autorine, r.name) for r in rows] == [
        ("7", "100", 1234.5, 0.25, "Žąsis"), ("8", "101", None, 2.0, "Ė")]
    (tmp_path / "plain.csv").write_bytes(data)
    assert R.read_legacy_report(spark, str(tmp_path / "plain.csv"), 2, names, "kodas").count() == 2


def test_export_columns(spark):
    df = spark.createDataFrame([(1, (2, "x")), (3, None)], "id int, place struct<osm_id:int,name:string>")
    out = E.export_frame(df, ["place.osm_id", "id", "twice"], computed={"twice": F.col("id") * 2})
    assert out.columns == ["place.osm_id", "id", "twice"]
    assert [tuple(r) for r in out.collect()] == [(2, 1, 2), (None, 3, 6)]
    assert E.export_frame(df, computed={"n": F.col("id")}, replace=True).columns == ["n"]


def test_export_files(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b", c'), (2, None)], "id int, t string")
    for fmt, sep in (("csv", ","), ("tsv", "\t")):
        E.export_table(df, str(tmp_path / fmt), fmt, ["t", "id"])
        back = spark.read.option("header", True).option("sep", sep).option("escape", '"').csv(str(tmp_path / fmt))
        assert back.columns == ["t", "id"] and sorted(map(tuple, back.collect()), key=str) == [('a "b", c', "1"), (None, "2")]


def test_seeds(spark):
    rows = spark.createDataFrame([("a", 3), ("b", 0), ("c", None)], "site string, n int")
    seeds = R.seed_urls(rows, "http://{site}/?page={page}", F.lit(1), F.col("n") + 1, keep=["site"])
    assert sorted((r.site, r.key) for r in seeds.collect()) == [("a", f"http://a/?page={i}") for i in (1, 2, 3)]


def test_a_table_is_refreshed_from_itself(spark, tmp_path):
    from tablewright.sources import tables as T

    path = str(tmp_path / "table")
    assert not T.exists(spark, path)
    T.overwrite_table(spark.range(10), path)
    T.overwrite_table(spark.read.parquet(path).where("id > 6"), path)
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [7, 8, 9]
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_a_plain_report_is_read_by_several_tasks(spark, tmp_path):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    body = b"".join("{}; Š\u012fmon\u0117 {};{},5\r\n".format(i, i, i).encode("iso-8859-4", "replace") for i in range(6000))
    for name in ("a.txt", "b.txt"):
        (tmp_path / name).write_bytes(b"first\n\n" + body)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        read = R.read_legacy_report(spark, str(tmp_path / "*.txt"), 1, {"n": "bigint", "who": "string", "x": "double"}, "n")
        assert spark.read.text(str(tmp_path / "*.txt")).rdd.getNumPartitions() > 8
        rows = {(r.file.rpartition("/")[2], r.line_no): (r.n, r.who, r.x, r.key) for r in read.collect()}
        who = "Š\u012fmon\u0117 ".encode("iso-8859-4", "replace").decode("iso-8859-4")
        assert rows == {(f, i + 3): (i, f"{who}{i}", i + 0.5, str(i)) for f in ("a.txt", "b.txt") for i in range(6000)}
        text = read._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in text and "InPandas" not in text
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_every_byte_of_an_encoding(spark):
    raw = spark.createDataFrame([(bytes(range(256)),)], "raw binary")
    for encoding in ("iso-8859-4", "cp1257", "iso-8859-13"):
        assert raw.select(R.decode_single_byte(F.col("raw"), encoding)).first()[0] == bytes(range(256)).decode(encoding, "replace")
