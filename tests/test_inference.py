import pytest
from pyspark.sql import types as T

from eventflow.operators.summary import grouped_summary
from eventflow.sources.delimited import bad_rows, good_rows
from eventflow.sources.inference import infer_types, read_inferred_csv, schema_of


def types(spark, values, **more):
    frame = spark.createDataFrame([(v,) for v in values], "c string")
    return infer_types(frame, ["c"], **more).first()


@pytest.mark.parametrize("values, kind", [
    (["1", "-22", None, ""], "bigint"), (["1", "1.5"], "decimal(38,9)"), (["1", "1e5", ".5"], "double"), (["9" * 20], "decimal(38,9)"),
    (["9" * 40, "1"], "double"), (["true", "FALSE"], "boolean"), (["true", "1"], "string"), (["2024-02-29"], "date"),
    (["2024-02-30"], "string"), (["2024-02-29", "2024-03-01 10:00:00.5"], "timestamp"), (["2024-02-29", "1"], "string"),
    ([None, ""], "string"), ([], "string"), (["x"], "string"), ([" 1"], "string"), (["1\n"], "string"),
])
def test_narrowest_type_that_takes_all(spark, values, kind):
    if not values:
        assert types(spark, values) is None
        return
    found = types(spark, values)
    assert (found.type, found.misfits, found.misfit) == (kind, 0, None)
    assert found["values"] == sum(bool(v) for v in values) and found.empty == sum(not v for v in values)


def test_misfits_up_to_a_share(spark):
    values = ["1"] * 18 + ["x", "b"]
    assert types(spark, values, tolerance=0.05).type == "string"
    found = types(spark, values, tolerance=0.1)
    assert (found.type, found.misfits, found.misfit) == ("bigint", 2, "b")
    # Nothing fits: a tolerance of all values is no reason to call texts numbers.
    assert types(spark, ["x", "y"], tolerance=1.0).type == "string"


def test_groups_and_columns_in_one_pass(spark):
    rows = [("h1", "1", "a"), ("h1", "2", "b"), ("h2", "1.5", "2024-01-01"), ("h2", None, "2024-01-02"), (None, "true", "1")]
    frame = spark.createDataFrame(rows, "header string, a string, b string")
    found = {(r.header, r.column): r.type for r in infer_types(frame, ["a", "b"], ["header"]).collect()}
    assert found == {
        ("h1", "a"): "bigint", ("h1", "b"): "string", ("h2", "a"): "decimal(38,9)", ("h2", "b"): "date",
        (None, "a"): "boolean", (None, "b"): "bigint",
    }


def test_csv_is_typed_by_its_values(spark, folder):
    with open(f"{folder}/t.csv", "w") as f:
        f.write("event_type,value,timestamp,share\n" + "a,1,2024-01-01 00:00:00,0.5\n" * 9 + "a,bad,2024-01-02 00:00:00,2\na,3\n")
    assert schema_of(infer_types(spark.createDataFrame([("1", "x")], "a string, b string"), ["a", "b"])) == T.StructType(
        [T.StructField("a", T.LongType()), T.StructField("b", T.StringType())]
    )
    typed = read_inferred_csv(spark, f"{folder}/t.csv", 0.2)
    assert [t for _, t in good_rows(typed).dtypes] == ["string", "bigint", "timestamp", "decimal(38,9)"]
    assert sorted(r.line for r in bad_rows(typed).collect()) == ["a,3", "a,bad,2024-01-02 00:00:00,2"]
    assert grouped_summary(good_rows(typed)).first().total_value == 9
    assert dict(read_inferred_csv(spark, f"{folder}/t.csv").dtypes)["value"] == "string"
