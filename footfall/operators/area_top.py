"""Area Top-N products (batch job J1), one function per stage.

Each stage is ``DataFrame -> DataFrame`` and stays lazy, so Catalyst sees
the whole chain: the date/click filter reaches the parquet scan, the city
dimension is joined as Spark's size check decides, the click count is a partial +
final hash aggregate (a hot product is pre-aggregated on the map side), and
the per-area Top-N becomes a ``WindowGroupLimit`` that is applied *before*
the shuffle by area, so an area holding a third of all rows ships at most
N rows per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from footfall.functions.aggregates import group_concat_distinct
from footfall.functions.columns import concat_long_string, json_field

# The reference's product status labels (0 = self-operated,
# anything else = third-party).
SELF_OPERATED = "自营商品"
THIRD_PARTY = "第三方商品"

# The reference's area -> level table; other areas get E级.
REFERENCE_AREA_LEVELS = {
    "华北": "A级", "华东": "A级",
    "华南": "B级", "华中": "B级",
    "西南": "C级", "西北": "C级",
    "东北": "D级",
}
DEFAULT_AREA_LEVEL = "E级"

# The same levels for the driver's region names.
TESTDATA_AREA_LEVELS = {
    "ASIA": "A级", "EUROPE": "A级",
    "AMERICA": "B级",
    "AFRICA": "C级",
    "MIDDLE EAST": "D级",
}

TOP_N_COLUMNS = ["area", "area_level", "product_id", "click_count", "city_infos",
                 "product_name", "product_status"]


def _bound(df: DataFrame, column: str, value: str):
    return F.lit(value).cast(df.schema[column].dataType)


def usable_click() -> F.Column:
    """FIL1: a click id that is neither null nor one of the texts for it."""
    pid = F.col("click_product_id")
    return pid.isNotNull() & ~pid.isin("null", "NULL")


def click_actions(actions: DataFrame, start: str, end: str) -> DataFrame:
    """FIL1 + FIL2 + PRJ1: usable click ids in [start, end], both inclusive.

    Returns (city_id, product_id); ids that are not numbers become NULL and
    never match a product.
    """
    t = F.col("action_time")
    in_range = (t >= _bound(actions, "action_time", start)) & (t <= _bound(actions, "action_time", end))
    return (actions.where(usable_click() & in_range)
            .select(F.col("city_id").cast("bigint").alias("city_id"),
                    F.col("click_product_id").try_cast("bigint").alias("product_id")))


def join_city(clicks: DataFrame, cities: DataFrame) -> DataFrame:
    """JN1 + PRJ2: clicks placed in their city and area (unknown city dropped)."""
    dim = cities.select(F.col("city_id").cast("bigint").alias("city_id"), "city_name", "area")
    return (clicks.join(dim, "city_id")
            .select("city_id", "city_name", "area", "product_id"))


def area_product_clicks(basic: DataFrame) -> DataFrame:
    """AG1 + AG2 + SC1: clicks per (area, product) and the sorted distinct
    'id;name' list of contributing cities.

    Two levels: raw clicks are first counted per (area, product, city) by a
    codegen'd hash aggregate with map-side combine; the set of city labels
    is then collected over those (far fewer) rows. Collecting straight from
    the clicks would run an object aggregate over every click, which falls
    back to sorting the raw rows once a task holds more than a few groups.
    """
    per_city = (basic.groupBy("area", "product_id", "city_id", "city_name")
                .agg(F.count(F.lit(1)).alias("n")))
    return (per_city.groupBy("area", "product_id")
            .agg(F.sum("n").alias("click_count"),
                 group_concat_distinct(concat_long_string("city_id", "city_name", ";"))
                 .alias("city_infos")))


def product_status_label(extend_info) -> F.Column:
    """PRJ3 over SC2: self-operated iff product_status is numerically 0."""
    status = json_field(extend_info, "product_status")
    return (F.when(status.try_cast("double") == 0, F.lit(SELF_OPERATED))
            .otherwise(F.lit(THIRD_PARTY)))


def with_product(area_counts: DataFrame, products: DataFrame) -> DataFrame:
    """JN2 + PRJ3: keep known products, add name and status label.

    No hint: the product dimension grows with the catalogue, so Spark's
    Spark's size check and AQE decide the strategy.
    """
    prod = products.select(F.col("product_id").cast("bigint").alias("product_id"),
                           "product_name",
                           product_status_label(F.col("extend_info")).alias("product_status"))
    return (area_counts.join(prod, "product_id")
            .select("area", "product_id", "click_count", "city_infos",
                    "product_name", "product_status"))


def area_level(area, levels: dict[str, str] = REFERENCE_AREA_LEVELS,
               default: str = DEFAULT_AREA_LEVEL) -> F.Column:
    """PRJ4: searched CASE from area to level, in level order."""
    a = F.col(area) if isinstance(area, str) else area
    by_level: dict[str, list[str]] = {}
    for ar, lv in levels.items():
        by_level.setdefault(lv, []).append(ar)
    expr = None
    for lv in sorted(by_level):
        cond = a.isin(*by_level[lv])
        expr = F.when(cond, F.lit(lv)) if expr is None else expr.when(cond, F.lit(lv))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def with_area_level(df: DataFrame, levels: dict[str, str] = REFERENCE_AREA_LEVELS) -> DataFrame:
    return df.withColumn("area_level", area_level("area", levels))


def top_n_per_area(df: DataFrame, n: int = 10) -> DataFrame:
    """WN1: the n most clicked products per area; ties by product id."""
    w = Window.partitionBy("area").orderBy(F.col("click_count").desc(), F.col("product_id").asc())
    return (df.withColumn("rn", F.row_number().over(w))
            .where(F.col("rn") <= n)
            .drop("rn"))


def area_top_products(actions: DataFrame, cities: DataFrame, products: DataFrame,
                      start: str, end: str, n: int = 10,
                      levels: dict[str, str] = REFERENCE_AREA_LEVELS) -> DataFrame:
    """The whole J1 chain (without persisting)."""
    basic = join_city(click_actions(actions, start, end), cities)
    full = with_product(area_product_clicks(basic), products)
    return top_n_per_area(with_area_level(full, levels), n).select(*TOP_N_COLUMNS)
