"""Types inferred from CSV text."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from ledgerline import sources
from ledgerline.sources import inference


@pytest.fixture
def types_in(spark):
    def infer(*cells, **options):
        df = spark.createDataFrame([(c,) for c in cells], "c string")
        state = inference.column_states(df, **options).first().asDict()
        (column,) = inference.types_of(state, **options)
        return (column.type_name, column.pattern) if column.pattern else column.type_name

    return infer


CASES = [
    (["1", "-20", None, "0"], "bigint"),
    (["9223372036854775807", "-9223372036854775808"], "bigint"),
    (["9223372036854775808"], "string"),
    (["1", "2.50", "-0.125", "1E7", "1.25e-3"], "double"),
    (["0.1", "123456789012345"], "double"),
    (["0.1", "1234567890123456"], "string"),  # the integer has more digits than a double keeps
    (["1234567890123456"], "bigint"),
    (["0.1234567890123456"], "string"),
    (["0.000001234567890"], "double"),
    (["1e-400"], "string"),
    (["1e400"], "string"),
    (["0.0", "0e5"], "double"),
    (["007", "7"], "string"),
    (["-0"], "double"),
    (["+5"], "string"),
    (["1 "], "string"),
    (["NaN"], "string"),
    (["1,000"], "string"),
    (["true", "False", None], "boolean"),
    (["true", "1"], "string"),
    (["2020-02-29", "1999-12-31"], ("date", "yyyy-MM-dd")),
    (["2020-02-30"], "string"),
    (["11/8/2016", "6/12/2016"], ("date", "M/d/yyyy")),
    (["13/8/2016", "6/12/2016"], ("date", "d/M/yyyy")),
    (["13/8/2016", "8/13/2016"], "string"),  # no one pattern
    (["01.02.2020"], ("date", "dd.MM.yyyy")),
    (["1.2.2020"], "string"),
    (["2020-01-01 10:00:00", "2020-01-01T10:00:00.25"], "timestamp_ntz"),
    (["2020-01-01 10:00:00", "2020-01-01"], "string"),
    (["2020-01-01 25:00:00"], "string"),
    ([None, None], "string"),
    ([], "string"),
]


@pytest.mark.parametrize(("cells", "expected"), CASES)
def test_types(types_in, cells, expected):
    assert types_in(*cells) == expected


def test_preferred_pattern_of_ambiguous_days(types_in):
    assert types_in("1/2/2020", date_patterns=("d/M/yyyy", "M/d/yyyy")) == ("date", "d/M/yyyy")


def test_states_of_parts_merge_to_the_state_of_all(spark):
    parts = [["1", None], ["2.5"], [None], ["x"]]
    for n in range(1, 5):
        states = [
            inference.column_states(spark.createDataFrame([(c,) for c in p], "c string")).first()["c"] for p in parts[:n]
        ]
        whole = inference.column_states(spark.createDataFrame([(c,) for p in parts[:n] for c in p], "c string")).first()["c"]
        stored = spark.createDataFrame([(s,) for s in states], "c bigint")
        assert inference.merge_states(stored).first()["c"] == whole


def test_one_aggregate_over_all_cells(spark, plan_of):
    df = spark.createDataFrame([("1", "a", "2020-01-01")], "a string, b string, c string")
    plan = plan_of(inference.column_states(df))
    assert plan.count("Exchange") == 1 and "SinglePartition" in plan and "partial_bit_and" in plan


def test_only_types_left_open_are_tested(spark, plan_of):
    df = spark.createDataFrame([("1", "8/13/2016"), (None, "1/2/2016"), ("2.5", None)], "a string, b string")
    every = inference.column_states(df).first()
    some = inference.column_states(df, among={"a": inference._BIGINT | inference._DOUBLE, "b": 0})
    assert "gettimestamp" in plan_of(inference.column_states(df)) and "gettimestamp" not in plan_of(some)
    assert (every["a"], every["b"]) == (inference._DOUBLE, inference._FIRST_DATE << 1) and tuple(some.first()) == (every["a"], 0)
    assert inference._left_open(df, inference.DATE_PATTERNS) == {"a": every["a"], "b": every["b"]}


def test_cells_after_the_first_rows_count(spark):
    n = inference._FIRST_ROWS
    long = "9" * (inference._FIRST_LENGTH + 1)  # no use in ruling out, but it counts
    columns = {
        "whole": ["1"] * (n + 1),
        "later_text": ["1"] * n + ["x"],
        "later_fraction": [None] * n + ["0.5"],
        "text": ["x"] * n + [None],
        "no cells": [None] * (n + 1),
        "long": [long] * (n + 1),
        "long_first": [long] + ["1"] * n,
        "day": ["1/2/2016"] * n + ["1/13/2016"],
        "bad day": ["2024-02-28"] * n + ["2024-02-30"],
        "moment": ["2020-01-01 10:00:00"] * n + [None],
    }
    schema = ", ".join(f"`{c}` string" for c in columns)
    df = spark.createDataFrame(list(zip(*columns.values())), schema).coalesce(1)
    found = inference.infer_columns(df)
    assert found == inference.types_of(inference.column_states(df).first().asDict())
    assert [c.type_name for c in found] == [
        "bigint", "string", "double", "string", "string", "string", "string", "date", "string", "timestamp_ntz",
    ]
    assert inference.infer_columns(df.select()) == []


def test_date_shapes_hold_what_can_be_parsed(spark):
    def fits(pattern, text):
        return spark.range(1).select(F.lit(text).rlike(inference._date_shape(pattern))).first()[0]

    assert fits("d/M/yyyy", "13/8/2016") and not fits("d/M/yyyy", "8/13/2016")
    assert not fits("yyyy-MM-dd", "2016-13-01") and not fits("dd.MM.yyyy", "00.01.2016")
    # Without something between them, parts are told by their number of digits only.
    assert fits("yyyyMMdd", "20161301") and fits("Mdyyyy", "1322016")


def test_read_inferred(spark, tmp_path, rows):
    file = tmp_path / "a.csv"
    file.write_text('id,a b,when,"x.y"\n1,"q, ""r""",3/4/2021,1.5\n2,,12/25/2021,\n3,"007",,2\n')
    df = sources.read_csv_inferred(spark, str(file))
    assert df.dtypes == [("id", "bigint"), ("a b", "string"), ("when", "date"), ("x.y", "double")]
    assert [(r[0], r[1], str(r[2]), r[3]) for r in df.collect()] == [
        (1, 'q, "r"', "2021-03-04", 1.5), (2, None, "2021-12-25", None), (3, "007", "None", 2.0),
    ]


def test_null_token_encoding_and_line_breaks(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('n,t\n1,"é\nx"\nNA,NA\n'.encode("latin-1"))
    df = sources.read_csv_inferred(spark, str(tmp_path / "a.csv"), null_token="NA", encoding="ISO-8859-1", multi_line=True)
    assert df.dtypes == [("n", "bigint"), ("t", "string")]
    assert [tuple(r) for r in df.collect()] == [(1, "é\nx"), (None, None)]


def test_header_only(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n")
    df = sources.read_csv_inferred(spark, str(tmp_path / "a.csv"))
    assert df.dtypes == [("a", "string"), ("b", "string")] and df.count() == 0
