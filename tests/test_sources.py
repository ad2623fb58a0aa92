"""Landing, exports and written layers."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starmill import Config, Layers
from starmill.config import LANDING_HEADERS
from starmill.plans import analysis, quality, views
from starmill.plans.catalogue import from_csv
from starmill.plans.layers import TABLES, WAVES
from starmill.sources import store
from starmill.sources.exports import export_csv, read_export
from starmill.sources.landing import land_csv, malformed_rows
from starmill.sources.store import LayerStore, bucket_count, shared_folder

HEADER = ",".join(LANDING_HEADERS.values())
ROWS = [
    'Photo Editor,ART_AND_DESIGN,4.1,159,19M,"10,000+",Free,0,Everyone,Art & Design,7-Jan-18,1.0.0,4.0.3 and up',
    'Two "Lines"\nApp,GAME,NaN,3,Varies with device,"1,000+",Paid,$4.99,Teen,Action;Puzzle,1-Feb-18,NaN,4.1'.replace(
        'Two "Lines"\nApp', '"Two ""Lines""\nApp"'
    ),
    "No Type,GAME,5,0,1k,0,NaN,0,Teen,Puzzle,31-Dec-99,,  ",
    'Shifted,1.9,19,3.0M,"1,000+",Free,0,Everyone,,11-Feb-18,1.0.19,4.0 and up',
]


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("csv") / "extract.csv"
    path.write_text("\n".join([HEADER, *ROWS]) + "\n")
    return land_csv(spark, str(path), multi_line=True)


def test_csv_lands_as_text(landed):
    rows = landed.orderBy("raw_id").collect()
    assert [r.raw_id for r in rows] == [1, 2, 3, 4]
    assert rows[1].app == 'Two "Lines"\nApp' and rows[0].installs == "10,000+"
    assert rows[2].type == "NaN" and rows[2].current_ver is None
    assert rows[3].category == "1.9" and rows[3].android_ver is None
    assert {f.dataType.simpleString() for f in landed.schema.fields[1:-1]} == {"string"}
    headers = {f.name: f.metadata.get("header") for f in landed.schema.fields}
    assert headers["content_rating"] == "Content Rating"
    assert rows[0].imported_at is not None


def test_null_tokens_become_null(spark, tmp_path):
    path = tmp_path / "extract.csv"
    path.write_text("\n".join([HEADER, *ROWS]) + "\n")
    landed = land_csv(spark, str(path), null_tokens=("NaN",), multi_line=True)
    rows = landed.orderBy("raw_id").collect()
    assert rows[2].type is None and rows[1].rating is None and rows[0].rating == "4.1"


def test_empty_cells_are_not_missing_cells(spark, tmp_path):
    cells = ['"Quoted "', '""', "", '" "', '""', ""]
    line = ",".join([*cells, *[""] * (len(LANDING_HEADERS) - len(cells))])
    (tmp_path / "x.csv").write_text("\n".join([HEADER, line]) + "\n")
    (row,) = land_csv(spark, str(tmp_path / "x.csv")).collect()
    assert list(row)[1:8] == ["Quoted ", "", None, " ", "", None, None]


def test_wrong_header_is_refused(spark, tmp_path):
    path = tmp_path / "extract.csv"
    path.write_text("Other," + HEADER.split(",", 1)[1] + "\n" + ROWS[0] + "\n")
    with pytest.raises(Exception, match="header|HEADER"):
        land_csv(spark, str(path)).collect()


def test_many_files_get_distinct_ids(spark, tmp_path):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text("\n".join([HEADER, *ROWS]) + "\n")
    rows = land_csv(spark, str(tmp_path), multi_line=True)
    assert sorted(r.raw_id for r in rows.collect()) == list(range(1, 13))


@pytest.mark.parametrize("split", ["128m", "3k"])
def test_ids_follow_files_and_lines_whatever_the_splits(spark, tmp_path, split):
    """A small file comes before a large one by its name, a large file is read in splits."""
    line = lambda i: f"App {i}" + "," * 12
    names = {"a.csv": range(3), "b.csv": range(3, 900), "c.csv": range(900, 904)}
    for name, ids in names.items():
        (tmp_path / name).write_text("\n".join([HEADER, *map(line, ids)]) + "\n")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = land_csv(spark, f"{tmp_path}/*.csv").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {r.raw_id: r.app for r in rows} == {i + 1: f"App {i}" for i in range(904)}


def _by_one_task(spark, path, null_tokens=()):
    """The same files read whole by Spark's own reader of records over several lines."""
    names = list(LANDING_HEADERS.values())
    schema = ", ".join(f"`{h}` string" for h in (*names, "bad"))
    reader = spark.read.schema(schema).option("header", True).option("escape", '"')
    reader = reader.option("multiLine", True).option("nullValue", "\uffff")
    return [tuple(r)[: len(names)] for r in reader.option("columnNameOfCorruptRecord", "bad").csv(path).collect()]


@pytest.mark.parametrize("split", ["128m", "1k", "200"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_cells_with_line_breaks_by_many_tasks(spark, tmp_path, split, end):
    """Files cut anywhere, inside cells too, give the rows that one task reads, in their order."""
    import random

    random.seed(11)
    pieces = ["a", "b c", "é", ",", end, end + end, '""', '"",""', " ", "x" * 40]
    for name in ("a.csv", "b.csv", "empty.csv", "one.csv"):
        lines = [HEADER]
        for i in range({"a.csv": 300, "b.csv": 40, "one.csv": 1}.get(name, 0)):
            cell = lambda: "".join(random.choice(pieces) for _ in range(random.randint(0, 6)))
            quoted = [f'"{cell()}"' if random.random() < 0.6 else random.choice(["", "y"]) for _ in range(12)]
            lines.append(",".join([f"App {name} {i}", *quoted]))
            if i % 50 == 7:
                lines.append("")
        (tmp_path / name).write_text(end.join(lines) + end, newline="")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        landed = land_csv(spark, f"{tmp_path}/*.csv", multi_line=True)
        rows = landed.orderBy("raw_id").collect()
        parts = landed.select("raw_id").rdd.getNumPartitions()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert [r.raw_id for r in rows] == list(range(1, 342)) and parts > 0
    expected = [r for n in ("a", "b", "one") for r in _by_one_task(spark, str(tmp_path / f"{n}.csv"))]
    assert [tuple(r)[1:-2] for r in rows] == expected
    assert any("\n" in (c or "") for r in expected for c in r)


def test_a_cell_that_is_never_closed_ends_with_its_file(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join([HEADER, ROWS[0], '"open', "still"]) + "\n")
    (tmp_path / "b.csv").write_text("\n".join([HEADER, ROWS[2]]) + "\n")
    rows = land_csv(spark, str(tmp_path), multi_line=True).orderBy("raw_id").collect()
    assert [(r.raw_id, r.app.split("\n")[0].strip('"')) for r in rows] == [
        (1, "Photo Editor"), (2, "open"), (3, "No Type"),
    ]


def test_wrong_header_of_records_is_refused(spark, tmp_path):
    (tmp_path / "x.csv").write_text("Other," + HEADER.split(",", 1)[1] + "\n" + ROWS[0] + "\n")
    with pytest.raises(ValueError, match="header"):
        land_csv(spark, str(tmp_path / "x.csv"), multi_line=True)


def test_malformed_lines_are_kept_and_listed(spark, tmp_path):
    long, short = ROWS[0] + ",14,15", "Only,three,cells"
    (tmp_path / "x.csv").write_text("\n".join([HEADER, ROWS[0], long, short, ROWS[2]]) + "\n")
    landed = land_csv(spark, str(tmp_path / "x.csv"))
    found = malformed_rows(landed).collect()
    assert sorted((r.raw_id, r.malformed_line) for r in found) == [(2, long), (3, short)]
    assert [r.app for r in landed.orderBy("raw_id").collect()] == [
        "Photo Editor", "Photo Editor", "Only", "No Type",
    ]


def test_csv_to_star(spark, tmp_path):
    """From file to KPIs through written layers; a second run replaces them."""
    path = tmp_path / "extract.csv"
    path.write_text("\n".join([HEADER, *ROWS]) + "\n")
    for _ in range(2):
        config = Config(app_sentinels=("Shifted",))
        ly = from_csv(spark, [str(path)], "csv_to_star", config, multi_line=True)
        ly.build_all()
    assert ly["fact"].count() == 3 and ly["raw"].count() == 4
    kpis = {r.genre_name: tuple(r)[1:] for r in analysis.genre_weighted_kpis(ly).collect()}
    assert kpis["Puzzle"] == (
        Decimal("1.5"), Decimal("1.5"), Decimal("500"), Decimal("5"), Decimal("5"),
    )
    assert kpis["Action"][3:] == (None, None)
    dates = {r.full_date.isoformat(): tuple(r)[2:] for r in ly["dim_last_updated_date"].collect()}
    assert dates["1999-12-31"] == (31, 12, 4, 1999, "December")
    types = {r.app_type_name for r in ly["dim_app_type"].collect()}
    assert types == {"Free", "Paid", "NaN", "Unknown"}
    again = Layers.written(LayerStore(spark, "csv_to_star", 4))
    assert sorted(again["fact"].collect()) == sorted(ly["fact"].collect())
    assert again["fact"].columns[:3] == ["app_snapshot_key", "snapshot_id", "raw_id"]


def test_append_equals_one_load_and_renumbers_nothing(spark, ly):
    """Of every table the stored rows and files stay, and all rows are those of one load."""
    first, second, third = (f"raw_id % 8 {part}" for part in ("< 5", "between 5 and 6", "> 6"))
    raw = ly["raw"]
    highest = raw.agg(F.max("raw_id")).first()[0]
    moved = lambda part, no: raw.where(part).withColumn("raw_id", F.col("raw_id") + no * highest)
    extracts = [moved(part, no) for no, part in enumerate((first, second, third))]
    store = LayerStore(spark, "appended_parts", 4)
    parts = Layers(extracts[0], ly.config, store)
    parts.build_all()
    names = [t for t in TABLES if t != "audit_log"]
    before = {t: (set(parts[t].collect()), set(parts[t].inputFiles())) for t in names}
    for more in extracts[1:]:
        parts.append(more)
    whole = Layers(extracts[0].unionByName(extracts[1]).unionByName(extracts[2]), ly.config)
    whole = Layers(whole["raw"], ly.config, given={t: whole[t].checkpoint() for t in TABLES})
    for t in names:
        rows, files = before[t]
        assert rows <= set(parts[t].collect()) and files <= set(parts[t].inputFiles()), t
        assert parts[t].count() == whole[t].count(), t
    for t in ("app", "genre", "snapshot", "bridge", "clean", "clean_bridge"):
        assert sorted(parts[t].collect(), key=str) == sorted(whole[t].collect(), key=str), t
    facts = [sorted(analysis.enriched_fact(x).collect(), key=str) for x in (parts, whole)]
    assert facts[0] == facts[1]
    with pytest.raises(ValueError, match="store"):
        whole.append(extracts[1])
    assert not [t.name for t in spark.catalog.listTables("appended_parts") if "__" in t.name]
    again = Layers.written(LayerStore(spark, "appended_parts", 4), ly.config)
    assert again["fact"].count() == whole["fact"].count()


def test_an_append_that_fails_leaves_every_table(spark, ly):
    parts = Layers(ly["raw"].where("raw_id < 500"), ly.config, LayerStore(spark, "append_fails", 4))
    parts.build_all()
    counts = {t: parts[t].count() for t in TABLES}
    bad = ly["raw"].where("raw_id >= 500").withColumn("genres", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        parts.append(bad)
    assert counts == {t: parts[t].count() for t in TABLES}


def test_ids_of_a_further_extract_go_on(spark, ly):
    highest = ly["raw"].agg(F.max("raw_id")).first()[0]
    more = ly.after(spark.range(1, 4).withColumnRenamed("id", "raw_id"))
    assert sorted(r.raw_id for r in more.collect()) == [highest + 1, highest + 2, highest + 3]


def test_waves_name_every_table_after_what_it_reads(ly):
    """Each table can be built from the tables of earlier waves alone."""
    assert sorted(t for wave in WAVES for t in wave) == sorted(TABLES)
    known = {}
    for wave in WAVES:
        for name in wave:
            alone = Layers(ly["raw"], ly.config, given=known)
            TABLES[name].build(alone)
            assert set(alone._tables) <= set(known), name
        known = {**known, **{name: ly[name] for name in wave}}


def test_store_replaces_whole_tables(spark):
    st = LayerStore(spark, "replacing", 4)
    first = st.write(spark.range(10), "t", "id", comment="Ten ids.")
    assert first.count() == 10 and len(first.inputFiles()) <= 4
    comment = spark.sql("describe table extended replacing.t").where("col_name = 'Comment'").first()
    assert comment.data_type == "Ten ids."
    twice = spark.range(3).withColumn("same", F.col("id"))
    again = st.write(twice, "t", "id", ("same",))
    assert again.columns == ["same", "id"]
    assert sorted(tuple(r) for r in again.collect()) == [(i, i) for i in range(3)]


def failing():
    return F.when(F.col("id") < 0, F.lit(1)).otherwise(F.raise_error(F.lit("lost")))


@pytest.mark.parametrize("key", [None, "id"])
def test_a_write_that_fails_leaves_the_former_table(spark, key):
    st = LayerStore(spark, "failing", 2)
    st.write(spark.range(10), "t", key)
    with pytest.raises(Exception, match="lost"):
        st.write(spark.range(5).withColumn("other", failing()), "t", key)
    assert st.read("t").count() == 10
    with pytest.raises(Exception, match="lost"):
        st.write(spark.range(5).withColumn("id", failing()), "t", key)
    assert sorted(r.id for r in st.read("t").collect()) == list(range(10))
    tables = [t.name for t in spark.catalog.listTables("failing") if not t.isTemporary]
    assert tables == ["t"]
    with pytest.raises(Exception, match="lost"):
        st.append(spark.range(5).withColumn("id", failing()), "t", key)
    assert st.read("t").count() == 10


def test_a_table_is_refreshed_from_itself_and_its_former_files_go(spark, tmp_path):
    st = LayerStore(spark, "refreshed", 2, f"file://{tmp_path}/r", "it's \\ here")
    st.write(spark.range(10), "t", "id", comment="Ann's \\ table")
    for _ in range(3):
        table = st.write(st.read("t").withColumn("id", F.col("id") + 1), "t", "id")
    assert sorted(r.id for r in table.collect()) == list(range(3, 13))
    wider = st.write(table.withColumn("more", F.lit("x")), "t", "id", comment="Ann's \\ table")
    assert wider.columns == ["id", "more"] and wider.count() == 10
    assert len(list((tmp_path / "r" / "t").iterdir())) == 1
    said = spark.sql("describe table extended refreshed.t").where("col_name = 'Comment'").first()
    assert said.data_type == "Ann's \\ table"


def test_append_adds_files_to_the_buckets_of_its_rows(spark):
    st = LayerStore(spark, "appending", 4)
    before = set(st.write(spark.range(10), "t", "id").inputFiles())
    after = st.append(spark.range(10, 12), "t", "id")
    assert sorted(r.id for r in after.collect()) == list(range(12))
    assert before < set(after.inputFiles()) and len(after.inputFiles()) <= len(before) + 2
    text = after.groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text


def test_store_uses_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert LayerStore(spark, "where", 2).location.startswith(shared_folder(spark))


def test_scratch_folder_only_in_local_mode():
    class Conf:
        def get(self, key, default):
            return default

    class Session:
        conf = Conf()

        class sparkContext:
            master, applicationId = "yarn", "app-1"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session())
    Session.sparkContext.master = "local[2]"
    assert shared_folder(Session()) == shared_folder(Session())


def test_bucket_count_grows_with_the_input(spark):
    cores = spark.sparkContext.defaultParallelism
    assert bucket_count(spark, 0) == cores
    assert bucket_count(spark, 100 * 2**40) == 100_000 < 100 * 2**40 // store.BUCKET_BYTES
    assert bucket_count(spark, 2**40) == 2**40 // store.BUCKET_BYTES == 1024
    assert bucket_count(spark, 2**60) == 100_000


def test_stores_leave_session_options_alone(spark):
    before = dict(spark.conf.getAll)
    LayerStore(spark, "no_options", 51_200)
    assert dict(spark.conf.getAll) == before


def test_store_lies_where_the_user_says(spark, tmp_path):
    st = LayerStore(spark, "elsewhere", 2, f"file://{tmp_path}/kept", "Kept tables")
    st.write(spark.range(5), "t", "id")
    assert any((tmp_path / "kept" / "t").glob("*/*.parquet"))
    assert "Kept tables" in str(spark.sql("describe database elsewhere").collect())


def test_export_round_trip(spark, ly, tmp_path):
    card = quality.baseline_scorecard(ly)
    path = str(tmp_path / "scorecard")
    export_csv(card, path)
    text = "".join(p.read_text() for p in (tmp_path / "scorecard").glob("*.csv"))
    assert ",null,null,null,INFO," in text and 'or equal to ""Varies with device""' in text
    back = read_export(spark, path, card.schema.simpleString()[7:-1].replace(":", " "))
    assert sorted(map(str, back.collect())) == sorted(map(str, card.collect()))


def test_export_views(spark, ly, tmp_path):
    views.export_views(ly, str(tmp_path), ["dw.v_dw_load_summary"])
    back = read_export(spark, str(tmp_path / "dw.v_dw_load_summary"), "metric string, value long")
    assert {r.metric: r.value for r in back.collect()}["fact_app_snapshot_rows"] == 1497
