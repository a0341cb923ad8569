"""Files, column checks, and where intermediate tables go."""

from pathlib import Path
from types import SimpleNamespace

import pytest

from basketry import session
from basketry.session import checkpoint_root, scope
from basketry.sources import files
from basketry.sources.columns import require_columns, resolve_roles
from tests.conftest import TESTDATA
from workloads.queries import QUERIES


def test_csv_is_read_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('InvoiceNo,Quantity\n1,2\n"",NA\n')
    df = files.read_lines(spark, str(tmp_path))
    assert df.dtypes == [("InvoiceNo", "string"), ("Quantity", "string")]
    assert sorted(map(tuple, df.collect()), key=str) == [("1", "2"), (None, "NA")]


def test_recursive_read_takes_csv_files_only(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "a.csv").write_text("c\n1\n")
    (tmp_path / "x" / "y" / "b.csv").write_text("c\n2\n")
    (tmp_path / "x" / "n.txt").write_text("c\n3\n")
    df = files.read_lines(spark, str(tmp_path), recursive=True)
    assert sorted(r["c"] for r in df.collect()) == ["1", "2"]


def test_first_csv_goes_folder_by_folder(spark, tmp_path):
    for name in ("a-b", "a", "z"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "m.csv").write_text("c\n1\n")
    (tmp_path / "a" / "a.txt").write_text("")
    assert files.first_csv(spark, str(tmp_path)).endswith("/a/m.csv")
    (tmp_path / "none").mkdir()
    with pytest.raises(FileNotFoundError, match="No CSV files found under"):
        files.first_csv(spark, str(tmp_path / "none"))


def test_parquet_copy_overwrites(spark, tmp_path):
    path = str(tmp_path / "copy")
    files.write_parquet(spark.range(3), path)
    files.write_parquet(spark.range(5), path)
    assert files.read_lines(spark, path, fmt="parquet").count() == 5


def test_profile_and_preview(spark, capsys):
    df = spark.range(7)
    assert tuple(files.profile(df).first()) == (7, 1)
    assert files.preview(df, 2).count() == 2
    assert "id: long" in capsys.readouterr().out


def test_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, c int")
    assert require_columns(df, ["a"]) is df
    with pytest.raises(ValueError, match="lacks b, d; it has a, c"):
        require_columns(df, ["d", "b", "a"])
    accepted = {"x": ["b", "c", "a"], "y": ["d"], "z": ["e", "f"]}
    assert resolve_roles(df, ["x"], accepted) == {"x": "c"}
    with pytest.raises(ValueError, match="no column for y \\(d\\); z \\(e / f\\)"):
        resolve_roles(df, ["x", "y", "z"], accepted)


def test_intermediate_tables_go_to_the_configured_folder(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    assert configured in (None, session.checkpoint_root(spark))
    table, rows = session.materialize_counted(spark.range(10).selectExpr("id % 3 AS k"))
    assert rows == table.count() == 10
    assert session.checkpoint_root(spark) + "/basketry/" in table.inputFiles()[0]


def unset_session(master, chosen):
    context = SimpleNamespace(
        getCheckpointDir=lambda: chosen[-1] if chosen else None,
        setCheckpointDir=chosen.append,
        master=master,
    )
    return SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context)


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_root(unset_session("yarn", []))


def test_local_mode_without_a_setting_gets_one_folder():
    chosen = []
    local = unset_session("local[2]", chosen)
    assert session.checkpoint_root(local) == session.checkpoint_root(local) == chosen[0]
    assert len(chosen) == 1


def test_discard_deletes_only_what_was_written_here(spark, tmp_path):
    table = session.materialize(spark.range(3))
    session.discard(table)
    assert not Path(table.inputFiles()[0].removeprefix("file:")).exists()
    files.write_parquet(spark.range(3), str(tmp_path / "given"))
    given = spark.read.parquet(str(tmp_path / "given"))
    session.discard(given, spark.range(1))
    assert given.count() == 3


@pytest.mark.parametrize("name", ["frequent_itemsets_maxk2", "best_threshold", "csv_ingest"])
def test_a_scope_leaves_no_tables(spark, name):
    root = Path(checkpoint_root(spark).removeprefix("file:")) / "basketry" / spark.sparkContext.applicationId
    before = {*root.glob("*")}
    with scope(spark):
        assert QUERIES[name](spark, TESTDATA).count() > 0
        assert {*root.glob("*")} - before
    assert {*root.glob("*")} == before
