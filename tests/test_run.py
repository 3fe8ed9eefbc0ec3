"""Layer selection, sinks, inputs and the run report."""

import pytest

from ledgerwell.plans.run import LAYERS, SelectionError, run_layers, selected_layers
from ledgerwell.plans.warehouse import Warehouse
from ledgerwell.schemas import RAW_TABLES, REFERENCE_TABLES
from ledgerwell.session import shared_folder
from ledgerwell.sources import inputs as sources
from ledgerwell.sources import sinks
from ledgerwell.sources.sinks import read_table, replace_table, schema_name, table_path


@pytest.mark.parametrize(
    ("select", "layers"),
    [
        ("staging", ["staging"]),
        ("marts staging", ["staging", "marts"]),
        ("intermediate+", ["intermediate", "marts"]),
        ("staging+ marts", ["staging", "intermediate", "marts"]),
        ("  *  ", ["staging", "intermediate", "marts"]),
        ("marts+", ["marts"]),
    ],
)
def test_selection(select, layers):
    assert selected_layers(select) == layers


def test_bad_selections_name_every_unknown_part():
    with pytest.raises(SelectionError, match="empty"):
        selected_layers("   ")
    with pytest.raises(SelectionError, match=r"nope, \+staging$"):
        selected_layers("nope staging +staging")


def test_schema_name():
    assert schema_name(None, "public") == "public"
    assert schema_name("marts", "public") == "marts"


def test_full_run_writes_every_mart(spark, warehouse, cfg, tmp_path):
    out = str(tmp_path / "out")
    report = run_layers(spark, warehouse.inputs, cfg, out, "*", full_refresh=True)
    assert (report.status, report.error, report.full_refresh) == ("success", None, True)
    assert report.started_at <= report.finished_at
    assert [r.model for r in report.results] == [m for models in LAYERS.values() for m in models]
    for result in report.results:
        if result.layer == "marts":
            assert read_table(spark, table_path(out, "marts", result.model)).count() == result.rows
    assert spark.table("stg_cash").count() == warehouse.stg_cash().count()
    facts = read_table(spark, table_path(out, "marts", "fct_transactions"))
    assert set(facts.columns) == set(warehouse.fct_transactions().columns)
    assert "accrual_month=1995-01-01" in " ".join(facts.inputFiles())
    again = run_layers(spark, warehouse.inputs, cfg, out, "marts")
    assert [(r.model, r.rows) for r in again.results] == [(r.model, r.rows) for r in report.results if r.layer == "marts"]


def test_failure_is_reported_and_the_rest_skipped(spark, warehouse, cfg, tmp_path):
    def load(table):
        if table == "cash":
            raise RuntimeError("no such table")
        return warehouse.inputs[table]

    report = run_layers(spark, sources.Inputs(load), cfg, str(tmp_path), "staging")
    status = {r.model: r.status for r in report.results}
    assert report.status == "error" and "stg_cash: no such table" in report.error
    assert (status["stg_card_personal"], status["stg_cash"], status["stg_wallet"]) == ("success", "error", "success")


def test_only_readers_of_a_failed_model_are_skipped(spark, warehouse, cfg, tmp_path, monkeypatch):
    """The calendar fails: salaries need it, the other marts do not; the old calendar stays."""
    out = str(tmp_path)
    spark.range(3).write.parquet(f"{out}/gold/dim_calendar")

    def fails(self):
        raise RuntimeError("no calendar")

    monkeypatch.setattr(Warehouse, "dim_calendar", fails)
    report = run_layers(spark, warehouse.inputs, cfg, out, "marts", schemas={"marts": "gold"})
    status = {r.model: r.status for r in report.results}
    assert (status["dim_calendar"], status["fct_salaries_monthly"]) == ("error", "skipped")
    assert (status["fct_transactions"], status["fct_capex_summary"], status["fct_monthly_pnl"]) == ("success",) * 3
    assert report.status == "error" and spark.read.parquet(f"{out}/gold/dim_calendar").count() == 3


def test_failed_write_leaves_the_table(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    with pytest.raises(Exception, match="(?i)divi"):
        replace_table(spark.range(5).selectExpr("1 / (id - 3) AS id"), path)
    assert read_table(spark, path).count() == 5
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_declared_column_order(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(4).selectExpr("id % 2 AS p", "id"), path, "p")
    assert read_table(spark, path, ["p", "id"]).columns == ["p", "id"]


def test_sink_replaces(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    replace_table(spark.range(2).selectExpr("id", "id % 2 AS p"), path, "p")
    assert sorted(tuple(r) for r in read_table(spark, path).collect()) == [(0, 0), (1, 1)]
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_file_inputs(spark, warehouse, tmp_path):
    root = str(tmp_path)
    cash = warehouse.inputs["cash"].limit(20)
    cash.write.parquet(f"{root}/cash")
    cash.write.option("header", True).csv(f"{root}/csv/cash")
    assert sources.from_files(spark, root)["cash"].count() == 20
    text = sources.from_files(spark, f"{root}/csv", "csv", header="true")["cash"]
    assert text.schema == RAW_TABLES["cash"]
    assert sorted(r.importe for r in text.collect()) == sorted(r.importe for r in cash.collect())
    with pytest.raises(KeyError):
        sources.from_files(spark, root)["other"]
    assert sources.from_frames({"cash": cash})["cash"] is cash
    cash.drop("saldo", "fecha").write.parquet(f"{root}/short/cash")
    with pytest.raises(ValueError, match="cash: missing columns fecha, saldo"):
        sources.from_files(spark, f"{root}/short")["cash"]


def test_catalog_inputs_look_in_both_schemas():
    tables = sources.from_catalog(Catalog())
    assert (tables["wallet"].name, tables["dim_account"].name) == ("raw.wallet", "stg.dim_account")
    with pytest.raises(ValueError, match="cash: missing columns"):
        sources.from_catalog(Catalog(lost=("saldo",)))["cash"]


class Table:
    def __init__(self, name, columns):
        self.name, self.columns = name, columns


class Catalog:
    """Stand-in for a session's catalog."""

    def __init__(self, lost=()):
        self.lost = lost

    def table(self, name):
        columns = sources.TABLES[name.split(".")[1]].names
        return Table(name, [c for c in columns if c not in self.lost])


class Span(Table):
    def first(self):
        return (3, 90)


def test_database_slices_follow_the_row_numbers_found():
    asked = []

    def read(options):
        asked.append(options)
        table = options["dbtable"]
        return Span("span", []) if "min(" in table else Table(table, sources.TABLES[table.split(".")[1]].names)

    tables = sources.sliced(read, "jdbc:x", "raw", "stg", 4, {"wallet": (1, 7)})
    assert tables["cash"].name == "raw.cash" and tables["dim_account"].name == "stg.dim_account"
    tables["wallet"]
    assert "FROM raw.cash" in asked[0]["dbtable"] and "partitionColumn" not in asked[0]
    assert (asked[1]["lowerBound"], asked[1]["upperBound"], asked[1]["numPartitions"]) == ("3", "90", "4")
    assert "partitionColumn" not in asked[2] and asked[3]["upperBound"] == "7" and len(asked) == 4


STEPS = ("write", "point", "clean")


@pytest.mark.parametrize("step", STEPS)
def test_a_crash_at_any_step_leaves_a_whole_table(spark, tmp_path, monkeypatch, step):
    path = str(tmp_path / "t")
    replace_table(spark.range(5), path)
    replace_table(spark.range(6), path)

    class Crash(BaseException):
        pass

    def crash(*_):
        raise Crash

    whole, store = sinks._point, sinks._store
    if step == "write":
        monkeypatch.setattr(sinks, "_point", crash)
    elif step == "point":
        monkeypatch.setattr(spark.sparkContext._gateway, "new_array", crash)
    else:
        monkeypatch.setattr(sinks, "_point", lambda *x: (whole(*x), crash()))
    with pytest.raises(Crash):
        replace_table(spark.range(7), path)
    monkeypatch.undo()
    assert store is sinks._store
    assert read_table(spark, path).count() == (7 if step == "clean" else 6)
    replace_table(spark.range(8), path)
    assert read_table(spark, path).count() == 8
    # The version before stays for its readers; nothing older does.
    assert len([p for p in (tmp_path / "t").iterdir() if p.is_dir()]) == 2


def test_a_grown_dictionary_is_measured_again(spark, cfg, tmp_path):
    path = str(tmp_path / "dim_categories")
    schema = sources.TABLES["dim_categories"]
    spark.createDataFrame([], schema).repartition(1).write.parquet(path)
    grown = Warehouse(spark, sources.from_files(spark, str(tmp_path)), cfg)
    first = grown.dimension("dim_categories")
    assert first.size.rows == 0 and grown.dimension("dim_categories") is first
    spark.createDataFrame([tuple(None for _ in schema)] * 3, schema).write.mode("append").parquet(path)
    assert grown.dimension("dim_categories").size.rows == 3


def test_database_options_slice_raw_tables_only():
    options = sources.jdbc_options("jdbc:x", "cash", "raw", 8, (1, 900))
    assert (options["partitionColumn"], options["numPartitions"], options["upperBound"]) == ("source_row_id", "8", "900")
    assert "partitionColumn" not in sources.jdbc_options("jdbc:x", "dim_account", "stg", 8, (1, 9))
    assert set(REFERENCE_TABLES) & set(RAW_TABLES) == set()


class Session:
    """Stand-in with the two places a setting may come from."""

    def __init__(self, settings, master="local[2]"):
        self.conf = settings
        self.sparkContext = self
        self.master = master

    def getConf(self):
        return {}


def test_shared_folder_prefers_the_cluster_setting(tmp_path):
    session = Session({"spark.checkpoint.dir": str(tmp_path)}, "yarn")
    first, second = shared_folder(session, "x"), shared_folder(session, "x")
    assert first.startswith(str(tmp_path)) and first != second
    assert shared_folder(Session({}), "x")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_folder(Session({}, "yarn"), "x")
