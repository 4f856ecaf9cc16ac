import json
import shutil

import pytest
from pyspark.sql import types as T

from lakeops.sources import files
from lakeops.streaming.ingest import drain


class Landing:
    """A folder of files and the bronze table that is drained from it."""

    def __init__(self, spark, folder, fmt, hints=None, **options):
        self.spark, self.folder, self.fmt = spark, folder, fmt
        self.hints, self.options = hints, options
        (folder / "landing").mkdir()

    def put(self, name, content):
        path = self.folder / "landing" / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content)

    def ingest(self, **more):
        f = str(self.folder)
        stream = files.read_file_stream(
            self.spark, f"{f}/landing", self.fmt, f"{f}/schema", self.options | more, self.hints
        )
        drain(stream, f"{f}/bronze", f"{f}/checkpoint", "test")
        return self.spark.read.parquet(f"{f}/bronze")


CSV = {"header": "true", "sep": ","}


def test_csv_reads_new_files_only(spark, tmp_path):
    landing = Landing(spark, tmp_path, "csv", "price double", **CSV)
    landing.put("a.csv", ",price,at\n0,1.5,x\n1,,y\n")
    assert landing.ingest().count() == 2
    assert landing.ingest().count() == 2
    landing.put("b.csv", ",price,at\n0,2.5,z\n")
    df = landing.ingest()
    assert df.count() == 3
    assert df.columns == [
        "_c0", "price", "at", "_rescued_data", "_ingested_filename", "_ingestion_time",
    ]
    assert {r._ingested_filename.rsplit("/", 1)[1] for r in df.collect()} == {"a.csv", "b.csv"}


def test_csv_keeps_what_does_not_fit(spark, tmp_path, rows):
    landing = Landing(spark, tmp_path, "csv", "price double, made date", **CSV)
    landing.put("a.csv", "id,price,made\n1,1.5,2025-01-01\n")
    landing.ingest()
    landing.put("b.csv", 'id,price,made\n2,cheap,2025-01-02\n3,1,2025-01-03,more\n"a,b",2,\n')
    got = {r.id: r for r in landing.ingest().collect()}
    assert got[2].price is None and json.loads(got[2]._rescued_data) == {"price": "cheap"}
    assert got[3].price == 1.0
    assert json.loads(got[3]._rescued_data) == {"_corrupt_record": "3,1,2025-01-03,more"}
    assert json.loads(got[None]._rescued_data) == {"id": "a,b"} and got[None].price == 2.0


def test_csv_header_with_more_or_fewer_columns(spark, tmp_path):
    landing = Landing(spark, tmp_path, "csv", "price double", **CSV)
    landing.put("a.csv", ",price,at\n0,1.5,x\n")
    landing.ingest()
    landing.put("b.csv", ",PRICE,at,new\n1,2.5,y,z\n")
    landing.put("c.csv", ",price\n2,3.5\n")
    got = {r._c0: r for r in landing.ingest().collect()}
    assert {k: (r.price, r["at"]) for k, r in got.items()} == {
        0: (1.5, "x"), 1: (2.5, "y"), 2: (3.5, None),
    }
    assert json.loads(got[1]._rescued_data) == {"_corrupt_record": "1,2.5,y,z"}


def test_csv_header_in_another_order_stops_the_stream(spark, tmp_path):
    landing = Landing(spark, tmp_path, "csv", "price double", **CSV)
    landing.put("a.csv", "id,price,at\n0,1.5,x\n")
    landing.ingest()
    landing.put("b.csv", "id,at,price\n1,y,2.5\n")
    with pytest.raises(ValueError, match="another order.*b.csv"):
        landing.ingest()
    landing.put("b.csv", "id,price,at\n1,2.5,y\n")
    assert landing.ingest().count() == 2


@pytest.mark.parametrize(
    ("text", "rows"),
    [
        ("name\nann\nname\nbob\n", [("ann",), ("name",), ("bob",)]),
        ("id,category,note\n,category,\n1,b,c\n", [(None, "category", None), (1, "b", "c")]),
        ("key,value\nvalue,key\na,b\n", [("value", "key"), ("a", "b")]),
        ("a,a,b\n1,2,3\n", [(1, 2, 3)]),
    ],
)
def test_csv_headers_go_by_place_and_rows_like_them_stay(spark, tmp_path, text, rows):
    landing = Landing(spark, tmp_path, "csv", **CSV)
    landing.put("a.csv", text)
    got = landing.ingest()
    assert sorted(map(str, (tuple(r)[:-3] for r in got.collect()))) == sorted(map(str, rows))


@pytest.mark.parametrize("fmt", ["csv", "json", "binaryFile"])
def test_folders_in_the_folder_are_read(spark, tmp_path, fmt):
    content = {"csv": "id,p\n{0},1\n", "json": '{{"id":{0}}}\n', "binaryFile": "{0}"}[fmt]
    landing = Landing(spark, tmp_path, fmt, **(CSV if fmt == "csv" else {}))
    for i, name in enumerate(["a", "sub/b", "sub/deep/c"]):
        landing.put(f"{name}.{fmt}", content.format(i))
    assert landing.ingest().count() == 3
    landing.put(f"late/d.{fmt}", content.format(9))
    assert landing.ingest().count() == 4


def test_schema_has_what_only_the_oldest_file_has(spark, tmp_path):
    landing = Landing(spark, tmp_path, "json")
    landing.put("old.json", '{"id":1,"rare":"x","n":"text"}\n')
    for i in range(30):
        landing.put(f"sub/{i}.json", f'{{"id":{i},"n":{i}}}\n')
    assert dict(landing.ingest().dtypes)["rare"] == "string"
    assert landing.ingest().schema["n"].dataType == T.StringType()


def test_dates_by_the_formats_of_the_reader(spark, tmp_path):
    for fmt, name, text in (("csv", "a", "id,d\n1,31/12/2024\n"), ("json", "b", '{"id":1,"d":"31/12/2024"}\n')):
        (tmp_path / fmt).mkdir()
        options = {"dateFormat": "dd/MM/yyyy", **(CSV if fmt == "csv" else {})}
        landing = Landing(spark, tmp_path / fmt, fmt, "d date", **options)
        landing.put(f"{name}.{fmt}", text)
        row = landing.ingest().first()
        assert row.d.isoformat() == "2024-12-31" and row._rescued_data is None


def test_nested_misfits_are_rescued(spark):
    schema = T.StructType.fromDDL("s struct<a:int,b:int>, l array<struct<a:int>>, m map<string,int>")
    lines = [
        '{"s":{"a":"bad","b":1}}',
        '{"s":{"a":2,"b":3,"z":9}}',
        '{"l":[{"a":"bad"}]}',
        '{"l":[{"a":1,"z":2}]}',
        '{"s":{"a":1,"b":null},"l":[{"a":1},null],"m":{"k":1}}',
        '{"m":{"k":"bad"}}',
    ]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    rescued = [r._rescued_data and json.loads(r._rescued_data) for r in files.rescue_json(df, schema).collect()]
    assert rescued == [
        {"s": '{"a":"bad","b":1}'}, {"s": '{"a":2,"b":3,"z":9}'}, {"l": '[{"a":"bad"}]'},
        {"l": '[{"a":1,"z":2}]'}, None, {"m": '{"k":"bad"}'},
    ]


def test_json_keeps_what_does_not_fit(spark, rows):
    df = spark.createDataFrame(
        [
            ('{"t":"bad","x":"8"}',),
            ('{"t":2,"x":"7","new":5}',),
            ('{"t":"12.5","x":9}',),
            ("junk",),
            ('{"c":[1,2],"deep":{"a":[1]}}',),
            (None,),
        ],
        "value string",
    )
    schema = T.StructType.fromDDL("t double, x string, c array<double>")
    got = files.rescue_json(df, schema).collect()
    assert [tuple(r) for r in got] == [
        (None, "8", None, '{"t":"bad"}'),
        (2.0, "7", None, '{"new":"5"}'),
        (12.5, "9", None, None),
        (None, None, None, '{"_corrupt_record":"junk"}'),
        (None, None, [1.0, 2.0], '{"deep":"{\\"a\\":[1]}"}'),
        (None, None, None, None),
    ]


def test_json_schema_is_inferred_once_with_hints(spark, tmp_path):
    landing = Landing(spark, tmp_path, "json", "t double, at string, gone int")
    landing.put("a.json", '{"t":1,"at":1740787200000,"coord":[40.5,-3]}\n\n')
    df = landing.ingest()
    assert dict(df.dtypes) == {
        "t": "double", "at": "string", "coord": "array<double>", "gone": "int",
        "_rescued_data": "string", "_ingested_filename": "string", "_ingestion_time": "timestamp",
    }
    assert df.first().at == "1740787200000"
    landing.put("b.json", '{"t":2,"extra":true}\n')
    df = landing.ingest()
    assert "extra" not in df.columns and df.count() == 2
    assert df.filter("t = 2").first()._rescued_data == '{"extra":"true"}'


def test_parquet_casts_to_hints_and_rescues_late_columns(spark, tmp_path):
    landing = Landing(spark, tmp_path, "parquet", "made date")
    folder = f"{tmp_path}/landing"
    spark.sql("SELECT 1 AS id, '2025-01-01' AS made, array(1.5D) AS coord").write.mode(
        "append"
    ).parquet(folder)
    assert landing.ingest().first().made.isoformat() == "2025-01-01"
    spark.sql("SELECT 2 AS id, 'soon' AS made, array(1, 2) AS late").write.mode("append").parquet(
        folder
    )
    df = landing.ingest()
    row = df.filter("id = 2").first()
    assert df.count() == 2 and row.made is None and row.coord is None
    assert json.loads(row._rescued_data) == {"made": "soon", "late": "[1,2]"}


def test_parquet_footers_are_read_once(spark, tmp_path, monkeypatch):
    landing = Landing(spark, tmp_path, "parquet")
    spark.range(3).write.parquet(f"{tmp_path}/landing/sub")
    assert landing.ingest().count() == 3
    found = list(files.new_files(spark, f"{tmp_path}/landing", {}, f"{tmp_path}/schema_stored_files"))
    assert found == []
    spark.range(2).selectExpr("id", "id AS late").write.parquet(f"{tmp_path}/landing/more")
    df = landing.ingest()
    assert df.count() == 5 and df.filter("_rescued_data LIKE '%late%'").count() == 2


def test_parquet_types_that_differ_are_cast_or_rescued(spark, tmp_path):
    landing, folder = Landing(spark, tmp_path, "parquet", "n int"), f"{tmp_path}/landing"
    spark.sql("SELECT 1 AS id, 5 AS n").write.parquet(f"{folder}/a")
    spark.sql("SELECT 2 AS id, 'six' AS n UNION ALL SELECT 3, '7'").coalesce(1).write.parquet(f"{folder}/b")
    assert landing.ingest().count() == 3
    spark.sql("SELECT 4L AS id, 8 AS n").write.parquet(f"{folder}/sub/c")
    spark.sql("SELECT 5 AS id, 9 AS n, 'x' AS late").write.parquet(f"{folder}/sub/d")
    spark.sql("SELECT 'six' AS id, '1' AS n").write.parquet(f"{folder}/e")
    landing.ingest()
    df = landing.ingest()
    got = [(r.id, r.n, r._rescued_data and json.loads(r._rescued_data)) for r in df.collect()]
    assert sorted(got, key=str) == sorted(
        [
            (1, 5, None), (2, None, {"n": "six"}), (3, 7, None), (4, 8, None),
            (5, 9, {"late": "x"}), (None, 1, {"id": "six"}),
        ],
        key=str,
    )
    assert all(f"{folder}/" in r._ingested_filename for r in df.collect())
    assert df.select("_ingestion_time").distinct().count() == 2


def test_parquet_files_of_other_types_are_cast_once_if_a_run_is_cut_off(spark, tmp_path):
    landing, folder = Landing(spark, tmp_path, "parquet"), f"{tmp_path}/landing"
    spark.sql("SELECT 1 AS id").write.parquet(f"{folder}/a")
    landing.ingest()
    spark.sql("SELECT 'two' AS id").write.parquet(f"{folder}/b")
    schema, location = T.StructType.fromDDL("id int"), f"{tmp_path}/schema_stored"
    # As if the run had ended after the cast and before the record of what was seen.
    shutil.copytree(f"{location}_files", tmp_path / "before")
    files.stored_schema(spark, folder, schema, {}, location)
    shutil.rmtree(f"{location}_files")
    shutil.copytree(tmp_path / "before", f"{location}_files")
    spark.sql("SELECT 'three' AS id").write.parquet(f"{folder}/c")
    df = landing.ingest()
    rescued = [r._rescued_data for r in df.filter("id IS NULL").collect()]
    assert sorted(rescued) == ['{"id":"three"}', '{"id":"two"}'] and df.count() == 3
    assert landing.ingest().count() == 3


def test_parquet_types_that_differ_from_the_start_become_common_ones(spark, tmp_path):
    landing = Landing(spark, tmp_path, "parquet")
    for i, row in enumerate(("1 AS a, 1 AS b, 1 AS c", "2L AS a, 2.5D AS b, 'x' AS c")):
        spark.sql(f"SELECT {row}").write.parquet(f"{tmp_path}/landing/{i}")
    df = landing.ingest()
    assert [df.schema[c].dataType for c in "abc"] == [T.LongType(), T.DoubleType(), T.StringType()]
    assert sorted((r.a, r.b, r.c) for r in df.collect()) == [(1, 1.0, "1"), (2, 2.5, "x")]
    assert df.filter("_rescued_data IS NOT NULL").count() == 0


def test_binary_files(spark, tmp_path):
    landing = Landing(spark, tmp_path, "binaryFile")
    landing.put("a.jpg", "xyz")
    landing.ingest()
    df = landing.ingest()
    assert df.columns == [
        "path", "modificationTime", "length", "content", "_ingested_filename", "_ingestion_time",
    ]
    row = df.first()
    assert df.count() == 1 and row.length == 3 and bytes(row.content) == b"xyz"


def test_files_per_batch_do_not_change_the_result(spark, tmp_path):
    landing = Landing(spark, tmp_path, "csv", "p double", **CSV)
    for i in range(5):
        landing.put(f"{i}.csv", f"id,p\n{i},{i}.5\n")
    df = landing.ingest(maxFilesPerTrigger="2")
    assert sorted((r.id, r.p) for r in df.collect()) == [(i, i + 0.5) for i in range(5)]
    assert df.select("_ingestion_time").distinct().count() == 3


def test_a_lost_sink_commit_is_made_up_on_the_next_run(spark, tmp_path):
    landing = Landing(spark, tmp_path, "csv", "p double", **CSV)
    landing.put("a.csv", "id,p\n1,1.5\n")
    landing.ingest()
    # As if the run had ended after the batch was planned and before it was committed.
    shutil.rmtree(tmp_path / "checkpoint" / "commits")
    assert landing.ingest().count() == 1


def test_unknown_format(spark, tmp_path):
    with pytest.raises(ValueError, match="xml"):
        files.read_file_stream(spark, str(tmp_path), "xml", "")


def test_empty_folder(spark, tmp_path):
    with pytest.raises(ValueError, match="no files"):
        files.infer_schema(spark, str(tmp_path), "csv")


class Batches(Landing):
    """The same by batches of file names."""

    def ingest(self, **more):
        f = str(self.folder)

        def write(rows, batch):
            rows.write.mode("overwrite").parquet(f"{f}/bronze/batch={batch}")

        files.drain_files(
            self.spark, f"{f}/landing", self.fmt, f"{f}/schema", f"{f}/checkpoint", write, "test",
            self.options | more, self.hints,
        )
        return self.spark.read.parquet(f"{f}/bronze")


def test_batches_of_csv_files(spark, tmp_path, rows):
    landing = Batches(spark, tmp_path, "csv", "price double", **CSV)
    for i in range(5):
        landing.put(f"{i}/a [{i}] *{{x}}.csv", f"id,price\n{i},1.5\n{i},cheap\n")
    landing.put("empty.csv", "")
    for _ in range(2):
        df = landing.ingest(maxFilesPerTrigger="2")
        assert df.select("batch").distinct().count() == 3
        got = rows(df, "id", "price", "_rescued_data")
        assert set(got) == {(i, None, '{"price":"cheap"}') for i in range(5)} | {(i, 1.5, None) for i in range(5)}
        assert len(got) == 10
    landing.put("b.csv", "price,id\n2,7\n")
    with pytest.raises(Exception, match="another order.*b.csv"):
        landing.ingest()
    assert landing.ingest_count() == 10


@pytest.mark.parametrize("kind", [Landing, Batches])
def test_csv_lines_need_not_have_a_column_that_only_a_hint_names(spark, tmp_path, kind, rows):
    landing = kind(spark, tmp_path, "csv", "price double, cost double", **CSV)
    landing.put("a.csv", "id,price\n1,1.5\n2,cheap\n3\n4,2\n")
    landing.ingest()
    landing.put("b.csv", "id,price,cost\n8,2.5,7.5\n9,2.5,low\n10,2.5,7.5,more\n11,2.5\n")
    got = rows(landing.ingest(), "id", "price", "cost", "_rescued_data")
    rescued = {r[0]: json.loads(r[3]) for r in got if r[3]}
    assert rescued[2] == {"price": "cheap"} and rescued[3] == {"_corrupt_record": "3"}
    assert rescued[9] == {"cost": "low"} and rescued[10] == {"_corrupt_record": "10,2.5,7.5,more"}
    values = {r[0]: r[1:3] for r in got}
    assert values[1] == (1.5, None) and values[8] == (2.5, 7.5) and values[11] == (2.5, None)
    assert not {1, 8, 11} & set(rescued)


def _count(self):
    return self.spark.read.parquet(f"{self.folder}/bronze").count()


Batches.ingest_count = _count


def test_batches_of_parquet_files_of_many_types(spark, tmp_path, rows):
    """Files that fit and files of other types in turn, some in each batch; none is written twice."""
    landing = Batches(spark, tmp_path, "parquet", "n int")
    types = ("int", "bigint", "string", "double")
    for i in range(12):
        kind = types[i % 4]
        spark.sql(f"SELECT CAST({i} AS {kind}) AS n, 'x' AS s").write.parquet(f"{tmp_path}/landing/{i:02}")
    for _ in range(2):
        df = landing.ingest(maxFilesPerTrigger="5")
        assert sorted(rows(df, "n", "s", "_rescued_data")) == [(i, "x", None) for i in range(12)]
    spark.sql("SELECT 'many' AS n, 'y' AS s, 1 AS late").write.parquet(f"{tmp_path}/landing/z")
    rescued = landing.ingest().filter("s = 'y'").select("n", "_rescued_data").collect()
    assert [(r.n, json.loads(r._rescued_data)) for r in rescued] == [(None, {"n": "many", "late": "1"})]
    assert sorted(p.name for p in tmp_path.iterdir()) == ["bronze", "checkpoint", "landing", "schema"]


def test_a_batch_of_files_that_is_cut_off_is_the_same_again(spark, tmp_path):
    landing = Batches(spark, tmp_path, "csv", **CSV)
    for i in range(4):
        landing.put(f"{i}.csv", f"id\n{i}\n")
    f, seen = str(tmp_path), []

    def cut(rows, batch):
        seen.append((batch, sorted(r.id for r in rows.collect()), rows.first()._ingestion_time))
        raise OSError("driver lost")

    for _ in range(2):
        landing.put(f"late{_}.csv", "id\n9\n")
        with pytest.raises(Exception, match="driver lost"):
            files.drain_files(spark, f"{f}/landing", "csv", f"{f}/schema", f"{f}/checkpoint", cut, "test", CSV)
    assert seen[0] == seen[1] and len(seen[0][1]) == 5
    assert landing.ingest().count() == 6


def _bytes_read(spark):
    every = spark._jvm.org.apache.hadoop.fs.FileSystem.getAllStatistics()
    return sum(s.getBytesRead() for s in every)


def test_header_check_reads_a_bounded_part_of_a_file(spark, tmp_path):
    read = []
    for name, lines in (("small", 60_000), ("large", 1_200_000)):
        path = tmp_path / f"{name}.csv"
        path.write_text("id,price,at\n" + "1,2.5,2025-01-01 00:00:00\n" * lines)
        before = _bytes_read(spark)
        found = [r.line for lines in files.first_lines(spark, [str(path)]) for r in lines.collect()]
        assert found == ["id,price,at"]
        read.append((path.stat().st_size, _bytes_read(spark) - before))
    (small, some), (large, part) = read
    assert large > 15 * small > 15 * files.SMALL_FILE and part == some < 100_000


def test_first_lines_of_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "SCANS_AT_ONCE", 7)
    for i in range(30):
        (tmp_path / f"{i}.txt").write_text(f"first {i}\nsecond\n" if i else "")
    for limit in (1 << 20, 0):
        monkeypatch.setattr(files, "SMALL_FILE", limit)
        found = [r.line for x in files.first_lines(spark, [str(p) for p in tmp_path.iterdir()]) for r in x.collect()]
        assert sorted(found) == sorted(f"first {i}" for i in range(1, 30))
