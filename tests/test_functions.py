import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row, functions as F, types as T

from stowage import Field, Index, SpaceSpec
from stowage.functions.names import snake_case, transform_columns, transformed_names
from stowage.functions.types import coerce, spark_type
from stowage.operators.mapping import to_records, to_rows
from stowage.operators.validate import validate_rows

# Names and their snake_case form.
SNAKE = {
    "COLUMN": "column",
    "someColumnNameRespectingCamel": "some_column_name_respecting_camel",
    "columnWITHSomeALLUppercaseWORDS": "column_with_some_all_uppercase_words",
    "_column": "_column",
    "column_": "column_",
    "Column": "column",
    "Column_S": "column_s",
    "Column_SV": "column_sv",
    "Column_String": "column_string",
    "_columnS": "_column_s",
    "column1234": "column1234",
    "column1234string": "column1234string",
    "ABcD": "a_bcd",
    "aBCd": "a_bcd",
    "a1B": "a1b",
}


@pytest.mark.parametrize("name,expected", SNAKE.items())
def test_snake_case(name, expected):
    assert snake_case(name) == expected


@given(st.text(alphabet="abAB1_", max_size=12))
@settings(max_examples=200, deadline=None)
def test_snake_case_only_adds_underscores(name):
    out = snake_case(name)
    assert out == out.lower()
    assert out.replace("_", "") == name.lower().replace("_", "")


def test_transforms(spark):
    df = spark.range(1).select(F.lit(1).alias("someName"), F.lit(2).alias("Other_NAME"))
    assert transform_columns(df).columns == ["someName", "Other_NAME"]
    assert transform_columns(df, "SNAKE_CASE").columns == ["some_name", "other_name"]
    assert transform_columns(df, "lower_case").columns == ["somename", "other_name"]
    assert transform_columns(df, "upper_case").columns == ["SOMENAME", "OTHER_NAME"]


def test_transforms_do_not_depend_on_each_other():
    assert transformed_names(["someName"], "snake_case") == {"someName": "some_name"}
    assert transformed_names(["someName"], "none") == {"someName": "someName"}


def test_colliding_names():
    with pytest.raises(ValueError, match="both become"):
        transformed_names(["someName", "some_name"], "snake_case")
    with pytest.raises(ValueError, match="unknown name transform"):
        transformed_names(["a"], "camel_case")


# Format type -> Spark type.
TYPES = {
    "any": "map<string,string>",
    "unsigned": "bigint",
    "string": "string",
    "number": "double",
    "double": "double",
    "integer": "bigint",
    "boolean": "boolean",
    "decimal": "decimal(38,18)",
    "uuid": "string",
    "datetime": "timestamp",
    "array": "array<string>",
    "map": "map<string,string>",
}


@pytest.mark.parametrize("name,expected", TYPES.items())
def test_format_types(name, expected):
    assert spark_type(name).simpleString() == expected
    assert spark_type(name.upper()).simpleString() == expected


def test_unknown_format_type():
    with pytest.raises(ValueError, match="scalar"):
        spark_type("scalar")
    with pytest.raises(ValueError, match="varbinary"):
        Field("x", "varbinary")


READING = (
    T.StructType()
    .add("station", "string")
    .add("sensor", "string")
    .add("volts", "float")
    .add("level", "double")
    .add("samples", "integer")
    .add("price", T.DecimalType(12, 2))
    .add("ok", "boolean")
    .add("taken", "timestamp")
)

READINGS = SpaceSpec(
    (
        Field("station", "string"),
        Field("sensor", "string", True),
        Field("volts", "number", True),
        Field("level", "double", True),
        Field("samples", "integer", True),
        Field("price", "decimal", True),
        Field("ok", "boolean", True),
        Field("taken", "datetime", True),
    ),
    (Index("station", ("station",)),),
)


def test_schema_of_a_space():
    assert [f.dataType.simpleString() for f in READINGS.schema()] == [
        "string", "string", "double", "double", "bigint", "decimal(38,18)", "boolean", "timestamp",
    ]
    assert all(f.nullable for f in READINGS.schema())
    assert READINGS.schema().names == READING.names


def reading(spark):
    return spark.sql(
        "SELECT 'north' station, null sensor, 3.25F volts, 0.1D level, 7 samples, 19.90BD price, true ok, "
        "timestamp'2031-07-08 09:10:11' taken"
    )


def test_record_to_row(spark):
    row = to_rows(reading(spark), READING).first()
    assert row[:5] == ("north", None, 3.25, 0.1, 7)
    assert str(row.price) == "19.90" and row.ok is True and row.taken.minute == 10


def test_record_without_the_fields_becomes_nulls(spark):
    out = to_rows(spark.range(1), READING)
    assert out.columns == READING.names
    assert out.first() == Row(*[None] * len(READING))


def test_required_columns(spark):
    out = to_rows(reading(spark), READING, ["samples", "station"])
    assert out.columns == ["samples", "station"] and out.first() == Row(7, "north")
    with pytest.raises(ValueError, match="humidity"):
        to_rows(reading(spark), READING, ["humidity"])


def test_nested_values_of_a_record(spark):
    df = spark.sql("SELECT null tag, array('40','5',null) depths, map('retries','6') limits")
    schema = T.StructType.fromDDL("tag string, depths array<int>, limits map<string,bigint>")
    assert to_rows(df, schema).first() == Row(None, [40, 5, None], {"retries": 6})


def test_row_to_record_by_name(spark):
    shuffled = reading(spark).select("taken", "samples", "ok", F.col("station").alias("Station"))
    out = to_records(shuffled, READINGS, "lower_case")
    assert out.columns == READINGS.names
    first = out.first()
    assert (first.station, first.samples, first.ok, first.volts) == ("north", 7, True, None)
    with pytest.raises(ValueError, match="not fields"):
        to_records(shuffled, READINGS)


def test_row_to_record_by_position(spark):
    names = [f"c{i}" for i in range(len(READING))]
    first = to_records(reading(spark).toDF(*names), READINGS, by="position").first()
    assert first.station == "north" and str(first.price) == "19.900000000000000000"
    short = to_records(spark.sql("SELECT 'south', 's1'"), READINGS, by="position").first()
    assert short[:3] == ("south", "s1", None)
    with pytest.raises(ValueError, match="9 columns"):
        to_records(reading(spark).toDF(*names).withColumn("more", F.lit(1)), READINGS, by="position")


NESTED = SpaceSpec(
    (Field("id", "string"), Field("items", "array"), Field("settings", "map"), Field("extra", "any", True)),
    (Index("id", ("id",)),),
)


def test_nested_values_to_a_record(spark):
    df = spark.sql(
        "SELECT 'a' id, array(1, null, 3) items, map('host', '127.0.0.1', 'port', null) settings, '{\"k\": 1}' extra"
    )
    assert to_records(df, NESTED).first() == Row(
        "a", ["1", None, "3"], {"host": "127.0.0.1", "port": None}, {"k": "1"}
    )
    df = spark.sql("SELECT 'a' id, '[1, \"b\", null]' items, map() settings, null extra")
    assert to_records(df, NESTED).first() == Row("a", ["1", "b", None], {}, None)
    df = spark.sql("SELECT 'a' id, array() items, named_struct('n', 1) settings, map(1, 2.5) extra")
    assert to_records(df, NESTED).first() == Row("a", [], {"n": "1"}, {"1": "2.5"})


def test_values_that_do_not_fit(spark):
    spec = SpaceSpec(
        (
            Field("id", "unsigned"),
            Field("n", "integer", True),
            Field("d", "decimal", True),
            Field("b", "boolean"),
        ),
        (Index("id", ("id",)),),
    )
    df = spark.sql(
        "SELECT * FROM VALUES (1L, '5', 1e30, true), (-2L, 'five', 2.5D, true), (null, '1.5', null, null) "
        "AS t(id, n, d, b)"
    )
    got = {r.n: r.violations for r in validate_rows(df, spec).collect()}
    assert got["5"] == ["field 3 (d): expected decimal, got double"]
    assert got["five"] == [
        "field 1 (id): expected unsigned, got a negative number",
        "field 2 (n): expected integer, got string",
    ]
    assert got["1.5"][0] == "field 1 (id): expected unsigned, got nil"
    assert got["1.5"][-1] == "field 4 (b): expected boolean, got nil"


def test_fractions_are_no_integers(spark):
    spec = SpaceSpec((Field("id", "unsigned"), Field("n", "integer", True)), (Index("id", ("id",)),))
    df = spark.sql("SELECT * FROM VALUES (1L, 2.0D), (2L, 2.5D) AS t(id, n)")
    got = {r.id: r.violations for r in validate_rows(df, spec).collect()}
    assert got == {1: [], 2: ["field 2 (n): expected integer, got double"]}


def test_coerce_fails_on_malformed_values(spark):
    df = spark.sql("SELECT 'x1' v")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        df.select(coerce(F.col("v"), T.LongType())).collect()


def test_spec_checks_and_text():
    assert SpaceSpec.from_json(READINGS.to_json()) == READINGS
    with pytest.raises(ValueError, match="unknown fields"):
        SpaceSpec((Field("a", "string"),), (Index("pk", ("b",)),))
    with pytest.raises(ValueError, match="primary key"):
        SpaceSpec((Field("a", "string"),), (Index("pk", ("a",), unique=False),))
    with pytest.raises(ValueError, match="distinct"):
        SpaceSpec((Field("a", "string"), Field("A", "string")), (Index("pk", ("a",)),))
    with pytest.raises(ValueError, match="no order"):
        SpaceSpec((Field("a", "string"), Field("m", "map")), (Index("pk", ("a",)), Index("m", ("m",))))
    for name in ("_seq", "_order3", "a.b"):
        with pytest.raises(ValueError, match="reserved"):
            SpaceSpec((Field(name, "string"),), (Index("pk", (name,)),))


def test_nested_values_keep_their_structure(spark):
    from stowage.functions.types import normalise, spark_type

    assert spark_type("Array<map< integer>>").simpleString() == "array<map<string,bigint>>"
    for wrong in ("array<", "list<string>", "map<nothing>", "array<string"):
        with pytest.raises(ValueError):
            spark_type(wrong)
    row = [([{"a": 1, "b": None}, None], {7: [1.0, 2.5]}, ("x", "y"), '{"k": [1, 2]}')]
    df = spark.createDataFrame(row, "m array<map<string, int>>, n map<int, array<double>>, s struct<p: string, q: string>, j string")
    types = {"m": "array<map<integer>>", "n": "map<array<integer>>", "s": "map<string>", "j": "map<array<unsigned>>"}
    got = df.select([normalise(df[c], df.schema[c].dataType, t).alias(c) for c, t in types.items()]).first()
    assert got.m == [{"a": 1, "b": None}, None]
    assert got.n == {"7": [1, None]}  # a fraction does not fit
    assert got.s == {"p": "x", "q": "y"} and got.j == {"k": [1, 2]}
    wrong = df.select(normalise(df.s, df.schema["s"].dataType, "array<string>").alias("w"))
    assert wrong.first().w is None and wrong.schema["w"].dataType == spark_type("array<string>")


def test_specs_of_nested_schemas():
    from stowage.spec import SpaceSpec

    schema = T._parse_datatype_string("id bigint, a array<struct<x: int, y: int>>, m map<string, array<string>>, z struct<p: int, q: string>")
    spec = SpaceSpec.from_schema(schema, ["id"], nested=True)
    assert [f.type for f in spec.fields] == ["integer", "array<map<integer>>", "map<array<string>>", "map<string>"]
    assert SpaceSpec.from_json(spec.to_json()) == spec
    with pytest.raises(ValueError, match="no order"):
        SpaceSpec.from_schema(schema, ["a"], nested=True)
