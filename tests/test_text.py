import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventflow.functions.text import event_key, event_sequence, render_line, scenario_id, strip, to_integer
from eventflow.sources.messages import as_messages

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
BLANKY = st.text(alphabet=st.sampled_from(list("ab:_+-09 \t\n\r\x0b\x1c\x1f\x85\xa0 　é中")), max_size=12)


def apply(spark, texts, *columns):
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, value string")
    return [tuple(r)[1:] for r in frame.select("i", *columns).orderBy("i").collect()]


@pytest.mark.parametrize("text,key,sequence", [
    ("a:1", "a", 1), (" b :2:3", "b", None), ("noseq", "noseq", None), (":5", "", 5), ("", "", None),
    ("  ", "", None), ("c\t:1", "c", 1), (" x:1", "x", 1), (None, "unknown", None), ("k: 7 ", "k", 7),
])
def test_message_edges(spark, text, key, sequence):
    column = F.col("value")
    assert apply(spark, [text], event_key(column), event_sequence(column)) == [(key, sequence)]


def test_strip_every_character(spark):
    points = [c for c in range(1, 0x30FF)]
    texts = [chr(c) + "x" + chr(c) for c in points]
    assert [r[0] for r in apply(spark, texts, strip(F.col("value")))] == [t.strip() for t in texts]


@SLOW
@given(st.lists(BLANKY, min_size=1, max_size=40))
def test_key_like_python(spark, texts):
    expected = [t.split(":", 1)[0].strip() for t in texts]
    assert [r[0] for r in apply(spark, texts, event_key(F.col("value")))] == expected


def python_int(text):
    try:
        value = int(text)
    except ValueError:
        return None
    return value if -(2**63) <= value < 2**63 else None


@SLOW
@given(st.lists(st.one_of(BLANKY.filter(lambda t: t.isascii()), st.integers(-(2**66), 2**66).map(str)), min_size=1, max_size=40))
def test_integers_like_python(spark, texts):
    assert [r[0] for r in apply(spark, texts, to_integer(F.col("value")))] == [python_int(t) for t in texts]


def test_scenario_id(spark):
    asked = ["1", "01", "007", "12", "0", "000", "123", "ab", "1a", ""]
    expected = ["01", "01", "07", "12", "00", "00", "123", "ab", "1a", ""]
    assert [r[0] for r in apply(spark, asked, scenario_id(F.col("value")))] == expected


def test_render_keeps_null_fields(spark):
    assert apply(spark, [None], render_line(F.col("value"), F.lit(3), sep=",")) == [(",3",)]


def test_as_messages(spark):
    frame = spark.createDataFrame([("a", 4)], "event_type string, event_id bigint")
    assert as_messages(frame).first().value == "a:4"
