"""Column helpers against plain-Python statements of the reference's rules."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from footfall.functions import columns as fc
from footfall.functions.aggregates import group_concat_distinct
from footfall.operators.cells import be_bytes_long, long_be_bytes


def java_split(s: str, sep: str) -> list[str]:
    """String.split semantics: trailing empty pieces removed."""
    parts = s.split(sep)
    while parts and parts[-1] == "":
        parts.pop()
    return parts if parts or s == "" else []


def py_get(bag: str, field: str):
    for piece in java_split(bag, "|"):
        kv = java_split(piece, "=")
        if len(kv) == 2 and kv[0] == field:
            return kv[1]
    return None


def py_set(bag: str, field: str, value: str) -> str:
    pieces = java_split(bag, "|")
    for i, piece in enumerate(pieces):
        name = (java_split(piece, "=") or [""])[0]
        if name == field:
            pieces[i] = f"{field}={value}"
            break
    return "|".join(pieces)


BAG_CASES = [
    "a=1|b=2|c=3", "k=", "k==v", "k=a=b", "k=v=", "k=v|k=w", "x=1|k=", "k|k=2", "", "|k=1|",
    "k=1||", "kk=1|k=2", "=v|k=3", "sessionid=1_20240101|age=20|city=上海", "k=1|k=2=|k=3",
]


def test_bag_get_cases(spark):
    rows = [(b,) for b in BAG_CASES]
    df = spark.createDataFrame(rows, "bag string")
    for field in ["k", "age", "city", "a", "sessionid", ""]:
        got = [r[0] for r in df.select(fc.bag_get("bag", field)).collect()]
        assert got == [py_get(b, field) for b in BAG_CASES], field


def test_bag_set_cases(spark):
    rows = [(b,) for b in BAG_CASES if b]
    df = spark.createDataFrame(rows, "bag string")
    for field, value in [("k", "9"), ("age", "30"), ("city", "北京"), ("a", "$1\\x"), ("zz", "1")]:
        got = [r[0] for r in df.select(fc.bag_set("bag", field, F.lit(value))).collect()]
        assert got == [py_set(r[0], field, value) for r in rows], field


piece = st.text(alphabet="ab=", min_size=0, max_size=5)


@settings(max_examples=60, deadline=None)
@given(st.lists(piece, min_size=1, max_size=6), st.sampled_from(["a", "b", "ab"]))
def test_bag_get_set_property(spark, pieces, field):
    bag = "|".join(pieces)
    df = spark.createDataFrame([(bag,)], "bag string")
    row = df.select(fc.bag_get("bag", field).alias("g"),
                    fc.bag_set("bag", field, F.lit("Z")).alias("s")).first()
    assert row["g"] == py_get(bag, field)
    assert row["s"] == py_set(bag, field, "Z")


def test_string_helpers(spark):
    df = spark.createDataFrame([(",a,b,",), (",,",), (",,a",), ("a",), ("",), (None,)], "s string")
    out = df.select(fc.trim_comma("s").alias("t"), fc.is_empty("s").alias("e")).collect()
    assert [r["t"] for r in out] == ["a,b", "", ",a", "a", "", None]
    assert [r["e"] for r in out] == [False, False, False, False, True, True]
    df2 = spark.createDataFrame([("5",), ("12",), ("123",)], "s string")
    assert [r[0] for r in df2.select(fc.fulfill("s")).collect()] == ["05", "12", "0123"]


def test_json_and_task_params(spark):
    df = spark.createDataFrame([
        ('{"startDate":["2024-01-01"],"endDate":["2024-01-31"]}',),
        ('{"startDate":[]}',), ("not json",), (None,)], "p string")
    out = df.select(fc.task_param("p", "startDate").alias("s"),
                    fc.task_param("p", "endDate").alias("e")).collect()
    assert [(r["s"], r["e"]) for r in out] == [("2024-01-01", "2024-01-31"), (None, None),
                                               (None, None), (None, None)]
    arr = spark.createDataFrame([('[{"学生":"张三","成绩":90},{"学生":"李四"}]',)], "j string")
    assert arr.select(fc.json_array_first_field("j", "学生")).first()[0] == "张三"
    js = spark.createDataFrame([('{"product_status":0}',), ('{"x":1}',), ("{bad",)], "j string")
    assert [r[0] for r in js.select(fc.json_field("j", "product_status")).collect()] == ["0", None, None]


def test_time_helpers(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00", "2024-01-01 00:01:05"),
                                ("bad", "2024-01-01 00:00:00")], "a string, b string")
    out = df.select(fc.time_minus_seconds("b", "a").alias("m"), fc.time_before("a", "b").alias("lt"),
                    fc.time_after("a", "b").alias("gt")).collect()
    assert [(r.m, r.lt, r.gt) for r in out] == [(65, True, False), (0, False, False)]
    ts = spark.createDataFrame([("2024-03-05 07:08:09",)], "t string").select(
        F.to_timestamp("t").alias("t"))
    r = ts.select(fc.format_date("t"), fc.format_date_key("t"), fc.date_hour("t"),
                  fc.format_time_minute("t")).first()
    assert tuple(r) == ("2024-03-05", "20240305", "2024-03-05_07", "202403050708")


def test_ratio_matches_exact_half_up(spark):
    from decimal import ROUND_HALF_UP, Decimal

    pairs = [(n, t) for t in range(1, 60) for n in range(0, t + 1)]
    df = spark.createDataFrame(pairs, "n long, t long")
    got = [r[0] for r in df.select(fc.ratio_2dp("n", "t")).collect()]
    want = [float((Decimal(n) / Decimal(t)).quantize(Decimal("0.01"), ROUND_HALF_UP)) for n, t in pairs]
    assert got == want
    assert spark.createDataFrame([(0, 0)], "n long, t long").select(fc.ratio_2dp("n", "t")).first()[0] is None


def test_group_concat_distinct_is_exact(spark):
    # D8: a substring test would lose '1;上海' once '11;上海' is present
    df = spark.createDataFrame([("x", "11;上海"), ("x", "1;上海"), ("x", "11;上海"), ("y", None)],
                               "g string, v string")
    out = dict(df.groupBy("g").agg(group_concat_distinct("v").alias("c")).collect())
    assert out == {"x": "11;上海,1;上海", "y": ""}


def test_long_bytes(spark):
    df = spark.createDataFrame([(15,), (-1,), (0,), (2**40 + 7,)], "v long")
    out = df.select(F.hex(long_be_bytes("v")).alias("h"), be_bytes_long(long_be_bytes("v")).alias("b")).collect()
    assert [r.h for r in out] == ["000000000000000F", "FFFFFFFFFFFFFFFF", "0000000000000000",
                                  "0000010000000007"]
    assert [r.b for r in out] == [15, -1, 0, 2**40 + 7]


def test_cli_task_id_and_defaults(spark):
    from footfall.plans.cli import parse_task_id

    assert parse_task_id(["42"]) == 42
    assert parse_task_id([]) is None
    assert parse_task_id(["x"]) is None
    r = spark.range(1).select(fc.today().alias("t"), fc.yesterday().alias("y")).first()
    assert len(r.t) == 10 and r.y < r.t


def test_sql_functions_match_column_helpers(spark):
    from footfall.plans.sql_surface import register_functions

    register_functions(spark)
    df = spark.createDataFrame([(b,) for b in BAG_CASES], "bag string")
    df.createOrReplaceTempView("bags_t")
    for field in ["k", "age", "city", "a"]:
        got = [r[0] for r in spark.sql(
            "SELECT get_field_from_concat_string(bag, '\\\\|', :f) FROM bags_t", args={"f": field}).collect()]
        assert got == [py_get(b, field) for b in BAG_CASES], field
    r = spark.sql("SELECT concat_long_string(11, '上海', ';') AS a, trim_comma(',x,') AS b, "
                  "fulfill('7') AS c, product_status_label('{\"product_status\":0}') AS d, "
                  "product_status_label(NULL) AS e").first()
    assert (r.a, r.b, r.c) == ("11;上海", "x", "07")
    assert (r.d, r.e) == ("自营商品", "第三方商品")


def test_cells_written_in_row_key_order(spark, run_dir):
    from footfall.operators.cells import to_cells, word_counts, write_cells

    words = spark.createDataFrame([(w,) for w in "b a c a b a zz 上海".split()], "w string")
    path = f"{run_dir}/cells"
    write_cells(to_cells(word_counts(words, "w"), "word", "count"), path, num_partitions=3)
    back = spark.read.parquet(path)
    got = {bytes(r.row_key).decode(): int.from_bytes(bytes(r.value), "big") for r in back.collect()}
    assert got == {"a": 3, "b": 2, "c": 1, "zz": 1, "上海": 1}
    # each file holds a contiguous, sorted key range
    per_file = back.withColumn("f", F.input_file_name()).groupBy("f").agg(
        F.min("row_key").alias("lo"), F.max("row_key").alias("hi")).orderBy("lo").collect()
    for a, b in zip(per_file, per_file[1:]):
        assert bytes(a.hi) < bytes(b.lo)


def test_jdbc_partitioned_read_needs_bounds(spark):
    import pytest

    from footfall.sources.jdbc import read_table

    with pytest.raises(ValueError):
        read_table(spark, "jdbc:none://nowhere/db", "city_info", partition_column="city_id",
                   lower_bound=0)           # no upper bound / partition count: refused before connecting


def test_sql_bag_and_list_helpers_match_columns(spark):
    from hypothesis import given, settings
    from hypothesis import strategies as st

    from footfall.plans.sql_surface import register_functions

    register_functions(spark)
    bags = st.text(alphabet="ab=|,$", max_size=12)

    @settings(max_examples=25, deadline=None)
    @given(st.lists(st.tuples(bags, st.text(alphabet="ab,", max_size=5), bags), min_size=1, max_size=8))
    def check(rows):
        df = spark.createDataFrame([(a, b, c) for a, b, c in rows], "bag string, v string, p string")
        df.createOrReplaceTempView("helpers_v")
        sql = spark.sql("""SELECT get_field_from_concat_string(bag, '\\\\|', 'a') AS g,
            set_field_in_concat_string(bag, '\\\\|', 'a', v) AS s, split_comma_list(v) AS l,
            valid_in(bag, 'a', p, 'a') AS i, valid_equal(bag, 'a', p, 'a') AS e,
            valid_between(bag, 'a', p, 'a', 'b') AS b, trim_comma(v) AS t FROM helpers_v""").collect()
        from footfall.operators import sessions as ss
        c = F.col
        col = df.select(fc.bag_get(c("bag"), "a").alias("g"), fc.bag_set(c("bag"), "a", c("v")).alias("s"),
                        fc.split_list("v").alias("l"), ss.in_param(c("bag"), "a", c("p"), "a").alias("i"),
                        ss.equal_param(c("bag"), "a", c("p"), "a").alias("e"),
                        ss.between_param(c("bag"), "a", c("p"), "a", "b").alias("b"),
                        fc.trim_comma("v").alias("t")).collect()
        assert sql == col

    check()
    # a list that ends in a comma, as the reference's split reads it
    assert spark.sql("SELECT valid_in('city=a,', 'city', 'cities=b,', 'cities')").first()[0] is False


def test_jdbc_helpers_refuse_unsafe_use(spark):
    import pytest

    from footfall.sources import jdbc

    with pytest.raises(ValueError, match="partition_column"):
        jdbc.read_table(spark, "jdbc:x:y", "t")
    with pytest.raises(ValueError, match="lower_bound"):
        jdbc.read_table(spark, "jdbc:x:y", "t", partition_column="id")
    with pytest.raises(ValueError, match="one task"):
        jdbc.read_query(spark, "jdbc:x:y", "SELECT 1")

    class Speculating:
        class sparkSession:  # noqa: N801
            conf = {"spark.speculation": "true"}

    with pytest.raises(ValueError, match="speculation"):
        jdbc.write_table(Speculating(), "jdbc:x:y", "t")


def test_shared_dir_needs_a_folder_on_a_cluster():
    import pytest

    from footfall.session import shared_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(Session())
