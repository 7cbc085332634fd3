import os

import pytest
from conftest import rows
from test_pipeline import FIRST, SECOND, write

from starlift import Lake, LakeConfig
from starlift.__main__ import parse
from starlift.plans import bronze, pipeline, run_bronze, run_landing
from starlift.sources.ledger import Ledger, files_of, signature


def test_entries(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    extract = tmp_path / "brands.csv"
    assert signature(spark, str(extract)) == "" and not ledger.holds("landing", "brands", "")
    extract.write_text("brand_id,brand_name\n1,a\n")
    mark = signature(spark, str(extract))
    assert not ledger.holds("landing", "brands", mark)
    ledger.record("landing", "brands", mark)
    assert ledger.holds("landing", "brands", mark) and not ledger.holds("bronze", "brands", mark)
    assert signature(spark, str(extract)) == mark != signature(spark, str(extract), "NULL")
    extract.write_text("brand_id,brand_name\n1,ab\n")
    assert not ledger.holds("landing", "brands", signature(spark, str(extract)))
    ledger.forget("landing", "brands")
    assert not ledger.holds("landing", "brands", mark)


def test_files_of_a_folder(spark, tmp_path):
    (tmp_path / "x" / "deep").mkdir(parents=True)
    for name in ("a", "deep/b", "_SUCCESS", ".hidden"):
        (tmp_path / "x" / name).write_text("12")
    assert [entry[:2] for entry in files_of(spark, str(tmp_path / "x"))] == [("a", 2), ("deep/b", 2)]


@pytest.fixture
def lake(spark, tmp_path):
    made = Lake(spark, LakeConfig(root=str(tmp_path / "lake"), prefix=f"ledger{os.path.basename(tmp_path)}_".replace("-", "_")))
    yield made
    made.drop()


def test_an_unchanged_extract_is_neither_copied_nor_parsed(spark, lake, tmp_path, monkeypatch):
    extract = write(tmp_path / "extract", FIRST)
    copied, read = [], []
    copy, load = pipeline.copy_csv, bronze.read_landing
    monkeypatch.setattr(pipeline, "copy_csv", lambda *given: copied.append(given[3]) or copy(*given))
    monkeypatch.setattr(bronze, "read_landing", lambda *given, **named: read.append(given[2]) or load(*given, **named))

    def run(lake):
        copied.clear(), read.clear()
        run_landing(lake, extract)
        run_bronze(lake)
        return sorted(copied), sorted(read)

    assert run(lake) == (sorted(FIRST), sorted(FIRST))
    assert run(lake) == ([], [])
    assert run(Lake(spark, lake.config)) == ([], [])  # what lasts are files
    (tmp_path / "extract" / "customers.csv").write_text(SECOND["customers"])
    assert run(lake) == (["customers"], ["customers"])
    assert len(rows(lake.read("bronze", "customers"))) == 3
    spark.sql(f"DROP TABLE {lake.name('bronze', 'brands')}")
    assert run(lake) == ([], [])  # its files are there
    assert run(Lake(spark, lake.config.parity())) == (sorted(FIRST), sorted(FIRST))


def test_a_step_that_died_is_done_again(lake, tmp_path, monkeypatch):
    extract = write(tmp_path / "extract", {"brands": FIRST["brands"]})
    run_landing(lake, extract)
    monkeypatch.setattr(pipeline, "ENTITIES", ["brands"])
    done = bronze.load_entity

    def dies(lake, entity):
        done(lake, entity)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(bronze, "load_entity", dies)
        with pytest.raises(RuntimeError, match="lost"):
            run_bronze(lake)
    again = []
    monkeypatch.setattr(bronze, "load_entity", lambda lake, entity: again.append(entity) or done(lake, entity))
    run_bronze(lake)
    run_bronze(lake)
    assert again == ["brands"] and lake.count("bronze", "brands") == 1


def test_layers_of_the_command_line():
    given = parse(["--root", "/r", "--layers", "silver,gold"])
    assert given.layers == ["silver", "gold"] and given.source is None
    with pytest.raises(SystemExit):
        parse(["--root", "/r", "--layers", "copper"])
    with pytest.raises(SystemExit):
        parse(["--root", "/r"])  # landing needs a source


def test_extracts_of_one_size_and_time_in_two_folders_are_two(spark, tmp_path):
    for day in ("first", "second"):
        (tmp_path / day).mkdir()
        (tmp_path / day / "stocks.csv").write_text(f"store_id,product_id,quantity\n1,1,{len(day)}\n")
        os.utime(tmp_path / day / "stocks.csv", (1_000_000_000, 1_000_000_000))
    assert signature(spark, f"{tmp_path}/first/stocks.csv") != signature(spark, f"{tmp_path}/second/stocks.csv")
