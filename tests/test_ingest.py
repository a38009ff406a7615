"""Landing folder and bronze load, on files written by the tests."""

import datetime
import uuid

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import StringType, StructField, StructType

from tests.landing_data import ROWS, write_csv, write_landing
from tidemark.schemas import RAW_COLUMNS, manifest, raw_schema
from tidemark.sources.bronze import (
    ReconciliationError,
    ingest_all_string,
    reconcile_counts,
    require_reconciled,
)
from tidemark.sources.csv import LINES, STITCHED, WHOLE, HeaderError, layout
from tidemark.sources.landing import (
    ArrivalError,
    append_arrival_log,
    arrival_check,
    read_modes,
)


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    return write_landing(tmp_path_factory.mktemp("landing"))


def test_arrival_counts_records_not_lines(spark, landing):
    got = {r["tabela"]: r for r in arrival_check(spark, landing, manifest()).collect()}
    assert {t: r["linhas"] for t, r in got.items()} == {t: len(rows) for t, rows in ROWS.items()}
    assert got["orders"]["arquivo"] == "orders.csv"
    assert got["orders"]["bytes"] > 300


def test_arrival_names_every_problem_at_once(spark, tmp_path):
    landing = write_landing(tmp_path / "in", orders=None, sellers=[], products=None)
    with pytest.raises(ArrivalError) as error:
        arrival_check(spark, landing, manifest())
    text = str(error.value)
    assert f"missing: {landing}/orders.csv, {landing}/products.csv" in text
    assert f"empty: {landing}/sellers.csv" in text


def test_arrival_of_a_folder_of_part_files(spark, tmp_path):
    landing = write_landing(tmp_path / "in with space", order_items=None)
    parts = tmp_path / "in with space" / "order_items.csv"
    parts.mkdir()
    for i in range(3):
        write_csv(parts / f"part{i}.csv", RAW_COLUMNS["order_items"], ROWS["order_items"])
    got = {r["tabela"]: r["linhas"] for r in arrival_check(spark, landing, manifest()).collect()}
    assert got["order_items"] == 15
    df = ingest_all_string(spark, f"{landing}/order_items.csv", raw_schema("order_items"))
    assert sorted({r[0] for r in df.select("_arquivo_origem").collect()}) == [
        "part0.csv",
        "part1.csv",
        "part2.csv",
    ]


def test_own_file_names(spark, tmp_path):
    write_csv(tmp_path / "x_orders_set.csv", RAW_COLUMNS["orders"], ROWS["orders"])
    names = manifest("x_{table}_set.csv", {"sellers": "other.csv"})
    assert names["sellers"] == "other.csv"
    got = arrival_check(spark, str(tmp_path), {"orders": names["orders"]}).collect()
    assert [(r["arquivo"], r["linhas"]) for r in got] == [("x_orders_set.csv", 5)]


def test_log_appends(spark, landing, tmp_path):
    log = str(tmp_path / "log")
    for day in (1, 2):
        when = datetime.datetime(2024, 1, day, tzinfo=datetime.timezone.utc)
        append_arrival_log(arrival_check(spark, landing, manifest(), checked_at=when), log)
    assert spark.read.parquet(log).count() == 18


def test_ingest_keeps_text_untouched(spark, landing):
    df = ingest_all_string(spark, f"{landing}/order_reviews.csv", raw_schema("order_reviews"))
    assert {t for c, t in df.dtypes if not c.startswith("_")} == {"string"}
    rows = {(r["review_id"], r["review_score"]): r for r in df.collect()}
    assert rows["r1", "5"]["review_comment_message"] == 'first line\nsecond "quoted" line'
    assert rows["r2", "4"]["review_comment_message"] == "one\n\ntwo, three"
    assert rows["r1", "1"]["review_comment_message"] is None
    assert rows["r1", "5"]["_arquivo_origem"] == "order_reviews.csv"


def test_ingest_without_schema_takes_the_header(spark, tmp_path):
    write_csv(tmp_path / "a.csv", ("x", "extra"), [("1", "2")])
    df = ingest_all_string(spark, str(tmp_path / "a.csv"))
    assert df.dtypes[:2] == [("x", "string"), ("extra", "string")]


def test_changed_header_fails(spark, tmp_path):
    write_csv(tmp_path / "sellers.csv", ("seller_id", "renamed", "seller_city", "seller_state"), ROWS["sellers"])
    df = ingest_all_string(spark, str(tmp_path / "sellers.csv"), raw_schema("sellers"))
    with pytest.raises(Exception, match="FAILED_READ_FILE|header"):
        df.collect()


def test_reconciliation_uses_the_newest_log_entry(spark):
    log = spark.createDataFrame(
        [("a", 1, 10), ("a", 2, 20), ("b", 1, 5)], "tabela string, conferido_em int, linhas long"
    )
    counts = spark.createDataFrame(
        [("a", 20), ("b", 4), ("c", 1)], "tabela string, linhas_bronze long"
    )
    reconciled = reconcile_counts(log, counts)
    assert {r["tabela"]: r["bate"] for r in reconciled.collect()} == {"a": True, "b": False, "c": False}
    with pytest.raises(ReconciliationError, match="b, c"):
        require_reconciled(reconciled)
    require_reconciled(reconciled.filter("bate"))


@pytest.mark.parametrize(
    "text, mode",
    [
        ("h1,h2\n1,2\n", LINES),
        ("h1,h2\r\n1,2\r\n", LINES),
        ("h1,h2\r\n1,2\n", WHOLE),
        ("h1,h2\n" + '"' + 'a""b' * 200_000 + '",x\n', LINES),
        ('h1,h2\n"a\nb",x\n', STITCHED),
        ('h1,h2\n"a\n""b,\n",","\n', STITCHED),
        # two stray quotes keep the quote count even although the field goes on
        ('h1,h2\na"b,"open\nrest",x\n', WHOLE),
        ('h1,h2\ntv 42" wide,screens\n', WHOLE),
        ('h1,h2\n"un"quoted" x",2\n', WHOLE),
        ('h1,h2\n"a"b,2\n', WHOLE),
        ("h1,h2\n  \n1,2\n", WHOLE),
    ],
)
def test_layout_follows_the_content(spark, tmp_path, text, mode):
    (tmp_path / "a.csv").write_bytes(text.encode())
    assert layout(spark, str(tmp_path / "a.csv")) == mode


@pytest.fixture
def tiny_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64b")
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def content(df):
    return sorted(map(tuple, df.drop("_ingerido_em").collect()), key=repr)


def test_big_files_are_read_in_parallel(spark, landing, tiny_splits):
    modes = read_modes(spark, landing, list(manifest().values()))
    assert modes["orders.csv"] == LINES and modes["order_reviews.csv"] == STITCHED
    got = arrival_check(spark, landing, manifest(), modes=modes).collect()
    assert {r["tabela"]: r["linhas"] for r in got} == {t: len(r) for t, r in ROWS.items()}
    for table, file in manifest().items():
        path, schema = f"{landing}/{file}", raw_schema(table)
        split = ingest_all_string(spark, path, schema, modes[file])
        assert content(split) == content(ingest_all_string(spark, path, schema))
    assert ingest_all_string(spark, f"{landing}/orders.csv", schema, LINES).rdd.getNumPartitions() > 1


@given(
    st.lists(
        st.tuples(*[st.text(st.sampled_from('ab ",\n\u00e9'), max_size=60)] * 3), min_size=1, max_size=12
    )
)
@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
def test_stitching_equals_whole_file_reading(spark, tmp_path, tiny_splits, rows):
    path = tmp_path / f"{uuid.uuid4().hex}.csv"
    write_csv(path, ("x", "y", "z"), rows)
    schema = StructType([StructField(c, StringType()) for c in "xyz"])
    split = ingest_all_string(spark, str(path), schema, STITCHED)
    assert content(split) == content(ingest_all_string(spark, str(path), schema))
    assert split.count() == len(rows)


def test_stitching_refuses_what_it_cannot_prove(spark, tmp_path):
    (tmp_path / "odd.csv").write_text('h1,h2\na"b,"open\nrest",x\n')
    schema = StructType([StructField(c, StringType()) for c in ("h1", "h2")])
    with pytest.raises(Exception, match="not a CSV record"):
        ingest_all_string(spark, str(tmp_path / "odd.csv"), schema, STITCHED).collect()
    with pytest.raises(HeaderError):
        ingest_all_string(spark, str(tmp_path / "odd.csv"), raw_schema("sellers"), STITCHED)


def test_an_unclosed_quote_is_an_error_not_one_huge_record(spark, tmp_path):
    (tmp_path / "open.csv").write_text("x\n" + "a\n" * 50 + '"open\n' + "a\n" * 500)
    with pytest.raises(ArrivalError, match="unclosed quote in .*open.csv"):
        read_modes(spark, str(tmp_path), ["open.csv"])


def outcome(spark, folder, limit):
    """Mode, arrival count and rows, or the error, with splits of this size."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", limit)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    try:
        modes = read_modes(spark, folder, ["a.csv"])
        counted = arrival_check(spark, folder, {"t": "a.csv"}, modes=modes).first()["linhas"]
        rows = content(ingest_all_string(spark, f"{folder}/a.csv", None, modes["a.csv"]))
        whole = content(ingest_all_string(spark, f"{folder}/a.csv"))
        assert rows == whole and counted == len(rows)
        return modes, counted, rows
    except ArrivalError as error:
        return str(error)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


@given(st.text(st.sampled_from('ab"",\n\n \u00e9'), max_size=150))
@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
def test_any_text_reads_alike_at_any_split_size(spark, tmp_path, text):
    """Stray, doubled and unclosed quotes: every way to read gives what reading whole files gives."""
    folder = tmp_path / uuid.uuid4().hex
    folder.mkdir()
    (folder / "a.csv").write_text("x,y\n" + text)
    small = outcome(spark, str(folder), "64b")
    assert small == outcome(spark, str(folder), "128m")


def test_names_with_plus_and_nested_folders(spark, tmp_path):
    write_csv(tmp_path / "cust+v2 %41.csv", ("x",), [("1",)])
    for part in ("a.csv", "dt=1/b+c.csv", "dt=1/x/d.csv"):
        path = tmp_path / "nested.csv" / part
        path.parent.mkdir(parents=True, exist_ok=True)
        write_csv(path, ("x",), [("1",), ("2",)])
    expected = {"plus": "cust+v2 %41.csv", "nested": "nested.csv"}
    got = {r["tabela"]: r for r in arrival_check(spark, str(tmp_path), expected).collect()}
    assert got["plus"]["linhas"] == 1 and got["nested"]["linhas"] == 6
    assert got["nested"]["bytes"] == 3 * (tmp_path / "nested.csv" / "a.csv").stat().st_size
    modes = read_modes(spark, str(tmp_path), list(expected.values()))
    for mode in (WHOLE, modes["nested.csv"], STITCHED):
        df = ingest_all_string(spark, str(tmp_path / "nested.csv"), None, mode)
        assert df.count() == 6
        assert {r[0] for r in df.select("_arquivo_origem").distinct().collect()} == {"a.csv", "b+c.csv", "d.csv"}
