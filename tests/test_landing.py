import csv
import gzip
import random

import pytest
from conftest import rows

from starlift.sources.landing import copy_csv, discover_csv, publish_csv, read_landing
from starlift.sources.records import has_broken_lines
from starlift.sources.schemas import schema_for

PRODUCTS = (
    "product_id,product_name,brand_id,category_id,model_year,list_price\n"
    '501,"Lamp ""Nord"", 40 cm",12,30,2031,18.75\n'
    '502," two, parts ",12,31,2031,7\n'
    "503,,12,30,2031,12\n"
)
STAFFS = (
    "staff_id,first_name,last_name,email,phone,active,store_id,manager_id\n"
    "1,Ann,Lee,ann@example.org,(555) 010-0000,1,1,NULL\n"
    "2,Bo,Ray,bo@example.org,(555) 010-0001,1,1,1\n"
)


@pytest.fixture
def extract(tmp_path):
    folder = tmp_path / "extract"
    folder.mkdir()
    (folder / "products.csv").write_text(PRODUCTS)
    (folder / "staffs.csv").write_text(STAFFS)
    (folder / "notes.txt").write_text("not an extract")
    return str(folder)


def test_only_csv_files_are_found(spark, extract):
    assert sorted(discover_csv(spark, extract)) == ["products", "staffs"]
    assert discover_csv(spark, f"{extract}/nothing") == {}


def test_quotes_commas_and_blanks(spark, extract):
    products = read_landing(spark, extract, "products")
    names = [row["product_name"] for row in products.orderBy("product_id").collect()]
    assert names == ['Lamp "Nord", 40 cm', " two, parts ", None]
    assert dict(products.dtypes) == {
        "product_id": "bigint",
        "product_name": "string",
        "brand_id": "bigint",
        "category_id": "bigint",
        "model_year": "bigint",
        "list_price": "double",
    }


def test_publishing_changes_nothing(spark, extract, tmp_path):
    landing = str(tmp_path / "landing")
    for entity, path in discover_csv(spark, extract).items():
        copy_csv(spark, path, landing, entity)
    for entity in ("products", "staffs"):
        assert rows(read_landing(spark, landing, entity)) == rows(read_landing(spark, extract, entity))


def test_publishing_again_replaces(spark, extract, tmp_path):
    landing = str(tmp_path / "landing")
    products = read_landing(spark, extract, "products")
    publish_csv(products, landing, "products")
    publish_csv(products.filter("product_id = 501"), landing, "products")
    assert read_landing(spark, landing, "products").count() == 1


def test_null_marker(spark, extract):
    as_text = read_landing(spark, extract, "staffs").orderBy("staff_id").collect()
    assert [row["manager_id"] for row in as_text] == ["NULL", "1"]
    types = schema_for("staffs", ["staff_id", "first_name", "last_name", "manager_id"]).simpleString()
    assert "manager_id:string" in types
    marked = read_landing(spark, extract, "staffs", null_marker="NULL").orderBy("staff_id").collect()
    assert [row["manager_id"] for row in marked] == [None, "1"]


def test_columns_follow_the_header(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("store_name,region,store_id\nNorth,left,4\n")
    stores = read_landing(spark, str(tmp_path), "stores")
    assert stores.dtypes == [("store_name", "string"), ("region", "string"), ("store_id", "bigint")]
    assert rows(stores) == [("North", "left", 4)]


def test_a_missing_column_is_refused(spark, tmp_path):
    (tmp_path / "stores.csv").write_text("store_name\nNorth\n")
    with pytest.raises(ValueError, match="store_id"):
        read_landing(spark, str(tmp_path), "stores")


def test_a_bad_value_is_not_read_as_null(spark, tmp_path):
    (tmp_path / "brands.csv").write_text("brand_id,brand_name\nx1,Name\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_landing(spark, str(tmp_path), "brands").collect()


@pytest.mark.parametrize("multiline", [False, True])
def test_line_breaks_in_quotes(spark, tmp_path, multiline):
    (tmp_path / "brands.csv").write_text('brand_id,brand_name\n1,"two\nlines"\n')
    assert rows(read_landing(spark, str(tmp_path), "brands", multiline=multiline)) == [(1, "two\nlines")]
    copy_csv(spark, f"{tmp_path}/brands.csv", str(tmp_path / "landing"), "brands", multiline=multiline)
    assert rows(read_landing(spark, str(tmp_path / "landing"), "brands", multiline=multiline)) == [(1, "two\nlines")]


def broken_brands():
    """Names with every awkward thing that may stand in quotes, some over many lines."""
    draw = random.Random(7)
    pieces = ['"', ",", "\n", "x", "\n\n", '"\n', ',"', "\n1,", "some words", "", "ü", "'", '""']
    return [(k, "n" + "".join(draw.choices(pieces, k=draw.randint(0, 9))) + ("\nline" * 40 if k % 50 == 0 else "")) for k in range(400)]


@pytest.mark.parametrize("line_end", ["\n", "\r\n"])
def test_a_file_with_line_breaks_is_read_by_many_tasks(spark, tmp_path, settings, line_end):
    settings(spark__sql__files__maxPartitionBytes="1024", spark__sql__files__openCostInBytes="0")
    given = broken_brands()
    folder = tmp_path / "brands.csv"
    folder.mkdir()
    for part, some in enumerate((given[:250], given[250:], [])):
        with open(folder / f"part-{part}.csv", "w", newline="") as file:
            writer = csv.writer(file, lineterminator=line_end)
            writer.writerows([("brand_id", "brand_name"), *some])
    assert len(spark.read.text(str(folder)).rdd.glom().collect()) > 5
    assert rows(read_landing(spark, str(tmp_path), "brands")) == sorted(given, key=repr)
    copy_csv(spark, str(folder), str(tmp_path / "landing"), "brands")
    assert rows(read_landing(spark, str(tmp_path / "landing"), "brands")) == sorted(given, key=repr)


def test_blocks_that_lie_inside_one_value(spark, tmp_path, settings):
    settings(spark__sql__files__maxPartitionBytes="64", spark__sql__files__openCostInBytes="0")
    long = "word, word\n" * 60 + "end"
    (tmp_path / "brands.csv").write_text(f'brand_id,brand_name\n1,"{long}"\n\n2,plain\n3,"{long}"\n')
    assert rows(read_landing(spark, str(tmp_path), "brands")) == [(1, long), (2, "plain"), (3, long)]


def test_an_inch_mark_without_quotes_is_no_line_break(spark, tmp_path):
    (tmp_path / "brands.csv").write_text('brand_id,brand_name\n1,5" pipe\n2,6" pipe\n')
    assert rows(read_landing(spark, str(tmp_path), "brands")) == [(1, '5" pipe'), (2, '6" pipe')]
    (tmp_path / "brands.csv").write_text('brand_id,brand_name\n1,5" pipe\n2,"6"" pipe\nof lead"\n3,7" pipe\n')
    assert rows(read_landing(spark, str(tmp_path), "brands")) == [(1, '5" pipe'), (2, '6" pipe\nof lead'), (3, '7" pipe')]


def test_broken_lines_do_not_hide_faults(spark, tmp_path):
    (tmp_path / "brands.csv").write_text('brand_id,brand_name\n1,"two\nlines",more\n')
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        read_landing(spark, str(tmp_path), "brands").collect()
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text('customer_id,first_name,last_name\n1,"A\nnn",Lee\n')
    (folder / "part-1.csv").write_text("customer_id,last_name,first_name\n2,Lee,Ann\n")
    with pytest.raises(ValueError, match="header"):
        copy_csv(spark, str(folder), str(tmp_path / "landing"), "customers")


@pytest.mark.parametrize("row", ["1,Acme, Inc", "1"])
def test_rows_that_do_not_fit_the_header_are_refused(spark, tmp_path, row):
    (tmp_path / "brands.csv").write_text(f"brand_id,brand_name\n{row}\n2,Other\n")
    with pytest.raises(Exception, match="MALFORMED|FAILFAST|Malformed"):
        copy_csv(spark, f"{tmp_path}/brands.csv", str(tmp_path / "landing"), "brands")


def test_parts_with_another_header_are_refused(spark, tmp_path):
    folder = tmp_path / "customers.csv"
    folder.mkdir()
    (folder / "part-0.csv").write_text("customer_id,first_name,last_name\n1,Ann,Lee\n")
    (folder / "part-1.csv").write_text("customer_id,last_name,first_name\n2,Lee,Ann\n")
    with pytest.raises(Exception, match="header"):
        copy_csv(spark, str(folder), str(tmp_path / "landing"), "customers")


def test_landing_parts_are_written_at_the_fastest_level(spark, tmp_path):
    rows = spark.range(0, 20_000, numPartitions=1).selectExpr("id as brand_id", "md5(cast(id % 500 as string)) as brand_name")
    publish_csv(rows, str(tmp_path), "brands")
    (part,) = (tmp_path / "brands.csv").glob("part-*.csv.gz")
    text = gzip.decompress(part.read_bytes())
    fast, usual = (len(gzip.compress(text, level)) for level in (1, 6))
    assert abs(part.stat().st_size - fast) < abs(part.stat().st_size - usual)


def test_line_breaks_are_found_in_quotes_only(spark, tmp_path):
    cases = {
        "plain": ('a,b\n1,x\n2,"y"\n', False),
        "doubled": ('a,b\n1,"x ""y"" z"\n2,""\n', False),
        "within": ('a,b\n1,6" wide\n', False),
        "broken": ('a,b\n1,x\n2,"y\nz"\n', True),
    }
    for name, (text, broken) in cases.items():
        (tmp_path / name).write_text(text)
        assert has_broken_lines(spark, str(tmp_path / name)) is broken
