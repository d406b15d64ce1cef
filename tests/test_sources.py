import json
import random

import pytest
from pyspark.errors import AnalysisException, PySparkException

from provider_analytics.sources import readers
from provider_analytics.sources.names import normalise
from provider_analytics.sources.registry import DATASETS, dataset, read_dataset
from provider_analytics.sources.schema import PROVIDER_COLUMNS, PROVIDER_HEADERS


@pytest.mark.parametrize(
    "header, expected",
    [
        ("Provider Last Name (Legal Name)", "provider_last_name_legal_name"),
        (
            "Provider Business Practice Location Address Country Code (If outside U.S.)",
            "provider_business_practice_location_address_country_code_if_outside_us",
        ),
        (" A-B/C  D ", "a_b_c__d"),
        ("Healthcare Provider Taxonomy Code_1", "healthcare_provider_taxonomy_code_1"),
    ],
)
def test_normalise(header, expected):
    assert normalise([header]) == [expected]


def test_provider_columns_are_distinct():
    assert len(set(PROVIDER_COLUMNS)) == len(PROVIDER_HEADERS) == 59


def test_unknown_dataset():
    assert list(DATASETS) == ["nppes", "nucc", "fips", "zip", "county_pop"]
    with pytest.raises(ValueError, match="unknown dataset"):
        dataset("claims")


def wide_file(spark, tmp_path, headers=PROVIDER_HEADERS):
    path = str(tmp_path / "nppes")
    columns = [*headers, "Not Kept"]
    schema = ", ".join(f"`{name}` string" for name in columns)
    rows = [tuple(f"{i}-{j}" for j in range(len(columns))) for i in range(3)]
    spark.createDataFrame(rows, schema).write.parquet(path)
    return path


def test_provider_scan_projects_and_renames(spark, tmp_path):
    df = read_dataset(spark, "nppes", wide_file(spark, tmp_path))
    assert df.columns == PROVIDER_COLUMNS
    assert sorted(r.npi for r in df.collect()) == ["0-0", "1-0", "2-0"]


def test_provider_scan_reads_used_columns_only(spark, tmp_path, capsys):
    df = read_dataset(spark, "nppes", wide_file(spark, tmp_path))
    df = df.select("npi", "provider_first_name")
    df.explain("formatted")
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<NPI:string,Provider First Name:string>" in plan


def test_missing_provider_column_is_an_error(spark, tmp_path):
    path = wide_file(spark, tmp_path, PROVIDER_HEADERS[:-1])
    with pytest.raises(AnalysisException):
        read_dataset(spark, "nppes", path)


def text_file(tmp_path, name, content):
    path = tmp_path / name
    path.write_text(content)
    return str(path)


def test_csv_keeps_rows_with_bad_fields(spark, tmp_path):
    path = text_file(
        tmp_path, "zip.csv", "COUNTY,ZIP,Res-Ratio\n1001,00501,0.5\nbad,602,\n,x,\"a, \"\"b\"\"\"\n"
    )
    df = read_dataset(spark, "zip", path)
    assert df.dtypes == [("county", "int"), ("zip", "int"), ("res_ratio", "string")]
    assert [tuple(r) for r in df.collect()] == [
        (1001, 501, "0.5"),
        (None, 602, ""),
        (None, None, 'a, "b"'),
    ]


def test_csv_files_of_a_folder_are_joined_by_name(spark, tmp_path):
    (tmp_path / "zips").mkdir()
    text_file(tmp_path / "zips", "a.csv", "ZIP,COUNTY,Note\n36103,502,x\n")
    text_file(tmp_path / "zips", "b.csv", '\n"COUNTY",Note,"ZIP"\n502,"y, ""z""",36104\nbad,,1\n')
    text_file(tmp_path / "zips", "c d.csv", "ZIP,COUNTY,Note\n")
    text_file(tmp_path / "zips", "empty.csv", "")
    df = read_dataset(spark, "zip", str(tmp_path / "zips"))
    assert df.dtypes == [("zip", "int"), ("county", "int"), ("note", "string")]
    found = sorted(map(tuple, df.collect()))
    assert found == [(1, None, ""), (36103, 502, "x"), (36104, 502, 'y, "z"')]


def test_csv_files_with_other_columns_are_an_error(spark, tmp_path):
    (tmp_path / "zips").mkdir()
    text_file(tmp_path / "zips", "a.csv", "ZIP,COUNTY\n36103,502\n")
    text_file(tmp_path / "zips", "b.csv", "COUNTY,PLACE\n502,36103\n")
    with pytest.raises(ValueError, match="headers differ"):
        read_dataset(spark, "zip", str(tmp_path / "zips"))


def test_csv_types_follow_all_fields(spark, tmp_path):
    rows = [
        "ZIP,COUNTY,whole,decimal,text,long,none,odd.name",
        "1,2,-5,1,7,9223372036854775807,,1",
        "3,4,+007,.5,8,1,,2",
        "5,6,,2e3,x,,,3",
    ]
    path = text_file(tmp_path, "zip.csv", "\n".join(rows) + "\n")
    df = read_dataset(spark, "zip", path, types={"oddname": "string"}, infer=True)
    assert [kind for _, kind in df.dtypes] == ["int", "int", "bigint", "double", "string", "bigint", "string", "string"]
    assert [tuple(r)[2:7] for r in df.collect()] == [
        (-5, 1.0, "7", 2**63 - 1, ""),
        (7, 0.5, "8", 1, ""),
        (None, 2000.0, "x", None, ""),
    ]


def test_csv_type_of_one_last_field(spark, tmp_path):
    """One text in the last of many rows makes the column text, unlike a look at the first."""
    rows = "\n".join(str(i) for i in range(5000))
    path = text_file(tmp_path, "zip.csv", f"ZIP\n{rows}\nNaN\n")
    [name] = readers.infer_types(readers.read_reference_csv(spark, path)) or ["text"]
    assert name == "text"
    df = readers.read_reference_csv(spark, text_file(tmp_path, "n.csv", f"n\n{rows}\n1.5\n"), infer=True)
    assert df.dtypes == [("n", "double")]


def test_csv_types_of_further_columns(spark, tmp_path):
    path = text_file(tmp_path, "zip.csv", "ZIP,COUNTY,RES_RATIO\n1,2,0.25\n3,4,\n5,6,x\n")
    df = read_dataset(spark, "zip", path, types={"res_ratio": "double"})
    assert [tuple(r) for r in df.collect()] == [(1, 2, 0.25), (3, 4, None), (5, 6, None)]


def test_csv_free_text_may_hold_line_breaks(spark, tmp_path):
    path = text_file(
        tmp_path,
        "nucc.csv",
        'Code,Grouping,Classification,Specialization,Definition\n'
        'A1,G,C,,"line one\nline ""two"""\n'
        'A2,G,C,S,\n',
    )
    rows = read_dataset(spark, "nucc", path).collect()
    assert [tuple(r) for r in rows] == [
        ("A1", "G", "C", "", 'line one\nline "two"'),
        ("A2", "G", "C", "S", ""),
    ]


def test_fill_null_text_leaves_numbers(spark):
    df = spark.createDataFrame([(None, None), (1, "a")], "n int, t string")
    assert [tuple(r) for r in readers.fill_null_text(df).collect()] == [(None, ""), (1, "a")]


MATRIX = [
    ["NAME", "B01001_001E", "state", "county"],
    ["Autauga, [A]", "58761", "01", "001"],
    ["Bald]]win", None, "01", "003"],
    ["[[Barbour \"x\"", "24757", "01", "005"],
]
ROWS = sorted(map(tuple, MATRIX[1:]))


def layouts():
    lines = ",\n".join(json.dumps(row) for row in MATRIX)
    return {
        "row per line": f"[{lines}]",
        "row per line, end of line": f"[{lines}]\r\n".replace("\n", "\r\n"),
        "one line": json.dumps(MATRIX),
        "compact": json.dumps(MATRIX, separators=(",", ":")),
        "matrix per line": "\n".join(json.dumps([MATRIX[0], row]) for row in MATRIX[1:]),
    }


@pytest.mark.parametrize("layout", layouts())
def test_json_matrix_line_layouts(spark, tmp_path, layout):
    path = text_file(tmp_path, "pop.json", layouts()[layout])
    df = read_dataset(spark, "county_pop", path)
    assert df.dtypes == [(name, "string") for name in MATRIX[0]]
    assert sorted(map(tuple, df.collect()), key=str) == sorted(ROWS, key=str)


ANY_LAYOUT = {
    "indented": json.dumps(MATRIX, indent=2),
    "one line": json.dumps(MATRIX),
    "compact, end of line": json.dumps(MATRIX, separators=(",", ":")) + " \r\n",
    "spread": json.dumps(MATRIX, indent=1).replace("\n", "\r\n\t "),
}


@pytest.fixture(params=["128m", "40b"])
def split(spark, request):
    """Files as they are, and in parts of 40 bytes."""
    before = {name: spark.conf.get(name) for name in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "1b")
    yield request.param
    for name, value in before.items():
        spark.conf.set(name, value)


@pytest.mark.parametrize("layout", ANY_LAYOUT)
def test_json_matrix_any_layout(spark, tmp_path, layout, split):
    path = text_file(tmp_path, "pop.json", ANY_LAYOUT[layout])
    df = readers.read_json_matrix(spark, path, multi_line=True)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(ROWS, key=str)


def test_a_matrix_on_one_line_is_read_by_many_tasks(spark, tmp_path, split):
    """Cells hold brackets, quotes, commas and backslashes wherever the file is cut."""
    draw = random.Random(8)
    alphabet = '[]{}",\\ \n\t:aé'
    header = ["NAME", "[a]", 'b"],["']
    rows = [
        ["".join(draw.choice(alphabet) for _ in range(draw.randrange(9))) for _ in header] for _ in range(300)
    ]
    rows += [[None, "", "]]"], ["],[", '"],["', "\\"]]
    for part in range(3):
        text_file(tmp_path, f"{part}.json", json.dumps([header, *rows[part::3]], ensure_ascii=part == 0))
    path = str(tmp_path / "*.json")
    df = readers.read_json_matrix(spark, path, multi_line=True)
    assert df.columns == header
    assert sorted(map(tuple, df.collect()), key=str) == sorted(map(tuple, rows), key=str)
    if split == "40b":
        text = spark.read.option("lineSep", "]").text(path)
        assert text.rdd.getNumPartitions() > 100
        used = text.selectExpr("_metadata.file_path AS f", "spark_partition_id() AS p").distinct()
        assert used.count() > 30


@pytest.mark.parametrize(
    "content, message",
    [
        (json.dumps(MATRIX)[:-1], "cut off"),
        (json.dumps(MATRIX)[:-1] + "\n", "cut off"),
        (json.dumps(MATRIX)[:-2], "malformed"),
        (json.dumps(MATRIX)[:-4], "malformed"),
        (json.dumps(MATRIX) * 2, "more than one JSON matrix"),
        (json.dumps(MATRIX, indent=2) + json.dumps(MATRIX), "more than one JSON matrix"),
        (json.dumps(MATRIX) + "x", "malformed"),
        (json.dumps(MATRIX) + "]", "cut off"),
        ('[["A"]],["1"]', "brackets"),
        (',["1"],[["A"]]', "malformed|brackets"),
        ('[["A"] ["1"]]', "malformed"),
        ('[["A"],["1"],]', "malformed"),
        ('[["A"],["1",["2"]]]', "malformed|fit header"),
        ('[["A","B"],["1"]]', "fit header"),
        ("", "no JSON matrix"),
        ("[[]]", "no JSON matrix"),
        ("[]", "malformed|no JSON matrix"),
        ("Unauthorized access", "malformed|no JSON matrix"),
    ],
)
def test_json_matrix_of_any_layout_fails_loudly(spark, tmp_path, content, message, split):
    path = text_file(tmp_path, "pop.json", content)
    with pytest.raises((ValueError, PySparkException), match=message):
        readers.read_json_matrix(spark, path, multi_line=True).collect()


def test_load_takes_any_layout(spark, tmp_path):
    path = text_file(tmp_path, "pop.json", json.dumps(MATRIX, indent=2))
    df = read_dataset(spark, "county_pop", path, multi_line=True)
    assert sorted(map(tuple, df.collect()), key=str) == sorted(ROWS, key=str)


def test_json_matrix_takes_any_text(spark, tmp_path):
    draw = random.Random(7)
    alphabet = '[]{}",\\ \n\r\t:aé\u2028'

    def cell():
        text = "".join(draw.choice(alphabet) for _ in range(draw.randrange(6)))
        return draw.choice([text, text, None])

    rows = [[cell(), cell(), cell()] for _ in range(600)]
    header = ["NAME", "[a]", "b]]"]
    blocks = [[header, *rows[start : start + 7]] for start in range(0, len(rows), 7)]
    one_line = "\n".join(json.dumps(block) for block in blocks)
    row_per_line = "\n".join(
        "[" + ",\n".join(json.dumps(row) for row in block) + "]" for block in blocks
    )
    expected = sorted(map(tuple, rows), key=str)
    for name, content in [("one_line", one_line), ("row_per_line", row_per_line)]:
        df = readers.read_json_matrix(spark, text_file(tmp_path, name, content))
        assert df.columns == header
        assert sorted(map(tuple, df.collect()), key=str) == expected


def test_json_matrix_numbers_become_text(spark, tmp_path):
    path = text_file(tmp_path, "pop.json", '[["NAME","B01001_001E"],["A",5],["B",null]]')
    assert [tuple(r) for r in readers.read_json_matrix(spark, path).collect()] == [
        ("A", "5"),
        ("B", None),
    ]


def test_json_matrix_without_rows(spark, tmp_path):
    path = text_file(tmp_path, "pop.json", json.dumps(MATRIX[:1]))
    assert readers.read_json_matrix(spark, path).count() == 0


@pytest.mark.parametrize(
    "content, message",
    [
        ("", "no JSON matrix"),
        ("Unauthorized access", "malformed JSON matrix|no JSON matrix"),
        ("[]", "no JSON matrix"),
        ("[[]]", "no JSON matrix"),
        (json.dumps(MATRIX)[:-9], "malformed JSON matrix"),
        (json.dumps(MATRIX)[:-1], "cut off"),
        (layouts()["row per line"][:-1], "cut off"),
        (layouts()["row per line"].rsplit("\n", 1)[0], "cut off"),
        (json.dumps(MATRIX, indent=2), "malformed JSON matrix|no JSON matrix"),
        ('[["A","B"],["1"]]', "does not fit header"),
        ('[["A"],["1"]][["A"],["2"]]', "more than one JSON matrix"),
        ('[["A"],\n["1"]] , [["A"],\n["2"]]', "more than one JSON matrix"),
        ('[["A","B"],["1","2"]]\n[["A","C"],["1","2"]]', "headers differ"),
    ],
)
def test_json_matrix_fails_loudly(spark, tmp_path, content, message):
    path = text_file(tmp_path, "pop.json", content)
    with pytest.raises((ValueError, PySparkException), match=message):
        readers.read_json_matrix(spark, path).collect()


def test_rename_population(spark, tmp_path):
    path = text_file(tmp_path, "pop.json", json.dumps(MATRIX))
    df = readers.rename_population(readers.read_json_matrix(spark, path))
    assert df.columns == ["NAME", "population", "state", "county"]
    assert dict(df.dtypes)["population"] == "string"
