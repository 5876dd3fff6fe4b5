from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewire.functions.instants import parse_instant
from tidewire.functions.text import hashed_uuid, is_blank, is_uuid, longer_than, numbered_uuid, utf16_length

texts = st.lists(
    st.one_of(st.none(), st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=12),
              st.text(alphabet=" \t\n\r\x00\x1f", max_size=4)),
    min_size=1, max_size=40,
)


def frame(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, s string")


def test_blank_is_any_run_of_characters_up_to_space(spark):
    values = [None, "", " ", "\t\n", "\x00\x1f", "a", " a ", " ", " "]
    got = [r.b for r in frame(spark, values).select("i", F.expr(is_blank("s")).alias("b")).orderBy("i").collect()]
    assert got == [True, True, True, True, True, False, False, False, False]


def test_length_counts_utf16_units(spark):
    values = ["a😀", "", "é", "a" * 2001]
    got = [r.n for r in frame(spark, values).select("i", F.expr(utf16_length("s")).alias("n")).orderBy("i").collect()]
    assert got == [3, 0, 1, 2001]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts)
def test_blank_and_length_agree_with_plain_python(spark, values):
    rows = frame(spark, values).select(
        "i", F.expr(is_blank("s")).alias("b"), *(F.expr(longer_than("s", n)).alias(f"over_{n}") for n in (0, 3, 5))
    ).orderBy("i").collect()
    for row, value in zip(rows, values, strict=True):
        assert row.b == (value is None or all(c <= " " for c in value))
        for n in (0, 3, 5):
            assert row[f"over_{n}"] == (value is not None and len(value.encode("utf-16-be")) // 2 > n)


def test_ids_have_uuid_form(spark):
    row = spark.range(255, 256).selectExpr(
        f"{numbered_uuid('id')} AS numbered",
        f"{hashed_uuid("'a'", "'b'")} AS hashed",
        f"{hashed_uuid("'ab'", "NULL")} AS other",
        f"{is_uuid("'not-a-uuid'")} AS bad",
    ).selectExpr("*", f"{is_uuid('numbered')} AS ok1", f"{is_uuid('hashed')} AS ok2").first()
    assert row.numbered == "00000000-0000-4000-8000-0000000000ff"
    assert row.ok1 and row.ok2 and not row.bad
    assert row.hashed != row.other


def test_numbers_of_all_64_bits_give_different_ids(spark):
    numbers = [0, 1, 2 ** 48 + 1, 2 ** 52 + 16, 2 ** 48 + 2 ** 52 + 1, -1, -2]
    rows = spark.createDataFrame([(n,) for n in numbers], "n long")
    ids = [r.id for r in rows.selectExpr(f"{numbered_uuid('n')} AS id").collect()]
    assert len(set(ids)) == len(numbers)
    assert ids[1] == "00000000-0000-4000-8000-000000000001"


def test_numeric_times_are_read_whole(spark):
    texts = ["1706000000", "1.706E9", "1706000000.1234567", "1706000000000", "-1.5"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    times = [str(r.at) for r in rows.selectExpr(f"{parse_instant('t')} AS at").collect()]
    assert times == [
        "2024-01-23 08:53:20", "2024-01-23 08:53:20", "2024-01-23 08:53:20.123456", "None", "1969-12-31 23:59:58.500000"]
