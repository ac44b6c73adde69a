"""The twelve source tables derived from the TPC-H-like test tables.

Facilities are numbered: stores 0-24 and DCs 50-74 by nation (76 replaces DC 51), partner origins 101-105 by
market segment, partner destinations 121-125 by order priority. Places follow from the number.

Rows that reach rules which the plain tables would not: partner lanes of three origins have loads for one truck a week, a
store is a campus of its own, another store has a second zip on some invoices, one listed distance is negative.

The fine grain has a DC per supplier, a partner origin per nation and segment, and a partner destination per
priority and order status, so that the graph grows with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deadhead.functions.geo import road_miles
from deadhead.schemas import SOURCES, conform

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
RETIRED_DC, NEW_DC, UNMAPPED_DC = 51, 76, 74
STORE_CAMPUS, TWO_ZIP_STORE, SCARCE_ORIGIN, SCARCE_VOLUME = 4, 7, 103, 40


def _lat(k: Column) -> Column:
    return (30 + (7 * k) % 13).cast("double")


def _lon(k: Column) -> Column:
    return (-(80 + (11 * k) % 17)).cast("double")


def _zip(k: Column) -> Column:
    return (10000 + k).cast("string")


def _miles(a: Column, b: Column) -> Column:
    return road_miles(_lon(a), _lat(a), _lon(b), _lat(b))


def _quarter_miles(a: Column, b: Column) -> Column:
    # sums of quarters are exact in any order
    return F.floor(_miles(a, b) * 4 + 0.5) / 4


def _name(prefix: str, k: Column) -> Column:
    return F.concat(F.lit(prefix), k.cast("string"))


def _city(k: Column) -> Column:
    return _name("City", k)


def _state(k: Column) -> Column:
    return _name("S", k % 10)


def _segment(segment: Column) -> Column:
    return (F.array_position(F.array(*[F.lit(s) for s in SEGMENTS]), segment) + 100).cast("int")


def _priority(priority: Column) -> Column:
    return F.substring(priority, 1, 1).cast("int") + 120


class _Tables:
    """The Parquet files of one folder; each footer is read once."""

    def __init__(self, spark: SparkSession, root: str, fine: bool):
        self.fine = fine
        for name in ("nation", "customer", "supplier", "orders", "lineitem"):
            setattr(self, name, spark.read.parquet(f"{root}/{name}.parquet"))


    # facility numbers, on supplier, customer and order columns

    def dc(self) -> Column:
        return (100000 + F.col("s_suppkey") if self.fine else 50 + F.col("s_nationkey")).cast("int")

    def partner_origin(self) -> Column:
        segment = _segment(F.col("c_mktsegment"))
        return (200000 + F.col("c_nationkey") * 5 + segment if self.fine else segment).cast("int")

    def partner_dest(self) -> Column:
        priority = _priority(F.col("o_orderpriority"))
        status = F.array_position(F.array(*[F.lit(c) for c in "FOP"]), F.col("o_orderstatus"))
        return (300000 + priority * 3 + status if self.fine else priority).cast("int")


def _invoice_lines(t: _Tables) -> DataFrame:
    customers = t.customer.select("c_custkey", F.col("c_nationkey").alias("store"))
    orders = t.orders.select("o_orderkey", "o_custkey")
    suppliers = t.supplier.select("s_suppkey", "s_nationkey", t.dc().alias("dc"))
    store, nation, dc = F.col("store"), F.col("s_nationkey"), F.col("dc")
    return (
        t.lineitem.select("l_orderkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_shipdate")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.concat_ws("-", "l_orderkey", "l_suppkey").alias("invoice_id"),
            _name("STR", store).alias("orig_fac_als_id"),
            F.lit("STR").alias("orig_fac_typ_ind"),
            (_zip(store) if t.fine else F.when((store == TWO_ZIP_STORE) & (F.col("l_linenumber") == 1), "99907").otherwise(_zip(store))).alias("orig_pstl_cd"),
            _name("DC", dc).alias("dest_fac_als_id"),
            F.element_at(F.array(F.lit("FDC"), F.lit("BDC"), F.lit("FDC/BDC")), (nation % 3 + 1).cast("int")).alias(
                "dest_fac_typ_ind"
            ),
            _zip(dc).alias("dest_pstl_cd"),
            F.when(nation % 5 != 0, _quarter_miles(store, dc) + F.col("l_linenumber")).alias("mile_cnt"),
            F.when(F.col("l_linenumber") != 3, F.to_date("l_shipdate")).alias("shp_dt"),
            F.when(F.col("l_returnflag") == "R", F.col("l_shipdate").cast("timestamp")).alias("arvl_ts"),
            F.lit(None).cast("timestamp").alias("dprt_ts"),
            F.when(F.col("l_returnflag") == "R", 25).otherwise(10).cast("long").alias("ond_shp_typ_cd"),
        )
    )


def _invoices(t: _Tables) -> DataFrame:
    suppliers = t.supplier.select("s_suppkey", _name("DC", t.dc()).alias("dc_nbr"))
    return (
        t.lineitem.select("l_orderkey", "l_suppkey")
        .distinct()
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(F.concat_ws("-", "l_orderkey", "l_suppkey").alias("invoice_id"), "dc_nbr")
    )


def _calendar(t: _Tables) -> DataFrame:
    day = F.to_date("l_shipdate")
    bounds = t.lineitem.agg(F.min(day).alias("lo"), F.max(day).alias("hi"))
    return bounds.select(F.explode(F.sequence("lo", "hi")).alias("cal_dt"))


def _segments(t: _Tables) -> DataFrame:
    return t.customer.select(t.partner_origin().alias("k")).distinct()


def _priorities(t: _Tables) -> DataFrame:
    return t.orders.select(t.partner_dest().alias("k")).distinct()


def _dc_numbers(t: _Tables) -> DataFrame:
    if t.fine:
        return t.supplier.select(t.dc().alias("k"))
    numbers = F.when(F.col("n_nationkey") == 0, F.array(F.lit(50), F.lit(NEW_DC))).otherwise(
        F.array(F.col("n_nationkey") + 50)
    )
    return t.nation.select(F.explode(numbers).alias("k"))


def _facilities(t: _Tables) -> DataFrame:
    def named(df: DataFrame, prefix: str) -> DataFrame:
        return df.select("k", _name(prefix, F.col("k")).alias("id"))

    stores = t.nation.select(F.col("n_nationkey").alias("k"))
    partners = _segments(t).unionByName(_priorities(t))
    return named(stores, "STR").unionByName(named(_dc_numbers(t), "DC")).unionByName(named(partners, "SRS_"))


def _campus_map(t: _Tables) -> DataFrame:
    k = F.col("k")
    carriers = F.when(k % 5 == 0, F.array(_name("C", k), _name("X", k))).otherwise(F.array(_name("C", k)))
    dcs = _dc_numbers(t).filter(k % 6 != 0).select(
        k.cast("long").alias("campus"),
        F.concat(_name("DC", k), F.lit(" - "), _city(k)).alias("campus_nbr_nm"),
        _name("DC", k).alias("campus_name"),
        F.explode(carriers).alias("scac"),
    )
    if t.fine:
        return dcs
    store = t.nation.select(F.col("n_nationkey").cast("int").alias("k")).filter(k == STORE_CAMPUS).select(
        k.cast("long").alias("campus"),
        F.concat(_name("STR", k), F.lit(" - "), _city(k)).alias("campus_nbr_nm"),
        _name("STR", k).alias("campus_name"),
        _name("C", k).alias("scac"),
    )
    return dcs.unionByName(store)


def _locations(t: _Tables) -> DataFrame:
    k = F.col("k")
    zips = F.when(k == 3, F.array(_zip(k), F.lit("99903"))).otherwise(F.array(_zip(k)))
    return _facilities(t).select(
        F.col("id").alias("loc_nbr"), _city(k).alias("city_nm"), _state(k).alias("st_cd"), F.explode(zips).alias("pstl_cd")
    )


def _partner_lanes(t: _Tables) -> DataFrame:
    lanes = (
        t.orders.select("o_custkey", t.partner_dest().alias("kd"))
        .join(t.customer.select("c_custkey", t.partner_origin().alias("ko")), F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("ko", "kd")
        .agg(F.count(F.lit(1)).alias("volume"))
    )
    ko, kd = F.col("ko"), F.col("kd")
    # longer than the direct way, or no three-leg tour could be mostly loaded
    distance = _miles(ko, kd) * F.when((ko + kd) % 2 == 0, 1.6).otherwise(1.1)
    return lanes.select(
        ko.cast("string").alias("origin_id"),
        F.when(~((ko == 104) & (kd == 121)), kd.cast("string")).alias("dest_id"),
        _zip(ko).alias("origin_zip"),
        F.when((ko == 105) & (kd == 125), F.lit("V5K1A")).otherwise(_zip(kd)).alias("destination_zip"),
        _city(ko).alias("origin_city"),
        _state(ko).alias("origin_state"),
        _city(kd).alias("destination_city"),
        _state(kd).alias("destination_state"),
        F.when(ko <= SCARCE_ORIGIN, F.least("volume", F.lit(SCARCE_VOLUME))).otherwise(F.col("volume")).alias("truckload_volume"),
        distance.alias("distance"),
        (2.5 * distance).alias("low_allin_cost"),
    )


def _distance_table(t: _Tables) -> DataFrame:
    near = t.nation.select(F.col("n_nationkey").alias("a")).unionByName(_dc_numbers(t).select(F.col("k").alias("a")))
    origins = _segments(t).select(F.col("k").alias("b"))
    pairs = near.filter(F.col("a") % 2 == 0).crossJoin(origins)
    a, b = F.col("a"), F.col("b")
    dist = F.when((a == 2) & (b == 103), -1.0).otherwise(1.05 * _miles(a, b))
    return pairs.select(_zip(a), _zip(b), dist, (a < 25).alias("ahead")).toDF("x", "y", "dist", "ahead").select(
        F.when(F.col("ahead"), F.col("x")).otherwise(F.col("y")).alias("o_zip"),
        F.when(F.col("ahead"), F.col("y")).otherwise(F.col("x")).alias("d_zip"),
        "dist",
    )


def _postal_codes(t: _Tables) -> DataFrame:
    k = F.col("k")
    zips = F.when(F.col("id") == f"STR{TWO_ZIP_STORE}", F.array(_zip(k), F.lit("99907"))).otherwise(F.array(_zip(k)))
    return _facilities(t).filter(k != UNMAPPED_DC).select(
        F.explode(zips).alias("postal_code"), _lon(k).alias("longitude"), _lat(k).alias("latitude")
    )


def _manual_distances(t: _Tables) -> DataFrame:
    k = F.col("k")
    return _priorities(t).select(
        _name("SRS_", k).alias("o_id"),
        F.lit(f"DC{UNMAPPED_DC}").alias("d_id"),
        _zip(k).alias("o_zip"),
        _zip(F.lit(UNMAPPED_DC)).alias("d_zip"),
        F.lit(777.0).alias("dist"),
    )


def _partner_rates(t: _Tables) -> DataFrame:
    lanes = _partner_lanes(t).filter(F.col("dest_id").isNotNull())
    numbers = F.col("origin_id").cast("int") + F.col("dest_id").cast("int")
    unknown = (F.col("origin_id") == "101") & (F.col("dest_id") == "122")
    return lanes.filter((numbers % 3 == 0) | unknown).select(
        F.col("origin_zip").alias("ozip"),
        F.col("destination_zip").alias("dzip"),
        F.when(~unknown, 3 * F.col("distance")).alias("bsl_rate"),
    )


def _dedicated_costs(t: _Tables) -> DataFrame:
    k = F.col("k")
    return (
        _dc_numbers(t)
        .filter(k % 11 != 0)
        .select(
            _name("DC", k).alias("dc_nbr"),
            F.explode(F.array(F.lit(-0.1), F.lit(0.1))).alias("off"),
            (1.0 + 0.1 * (k % 5)).alias("base"),
            (50.0 + k % 100).alias("stop_charge"),
            (40.0 + k % 7).alias("fixed_cost_per_hour"),
        )
        .select("dc_nbr", (F.col("base") + F.col("off")).alias("variable_cpm"), "stop_charge", "fixed_cost_per_hour")
    )


def _transitions(t: _Tables) -> DataFrame:
    return t.nation.filter(F.col("n_nationkey") + 50 == RETIRED_DC).select(
        _name("DC", F.lit(RETIRED_DC)).alias("old_bdc_nbr"), _name("DC", F.lit(NEW_DC)).alias("new_bdc_nbr")
    )


_BUILDERS = {
    "invoice_lines": _invoice_lines,
    "invoices": _invoices,
    "calendar": _calendar,
    "dc_transitions": _transitions,
    "campus_map": _campus_map,
    "locations": _locations,
    "partner_lanes": _partner_lanes,
    "distance_table": _distance_table,
    "postal_codes": _postal_codes,
    "manual_distances": _manual_distances,
    "partner_rates": _partner_rates,
    "dedicated_costs": _dedicated_costs,
}


class TestdataSources:
    """The tables of ``Sources``, each derived on first use."""

    __test__ = False

    def __init__(self, spark: SparkSession, root: str, fine: bool = False):
        self._tables = _Tables(spark, root, fine)

    def __getattr__(self, name: str) -> DataFrame:
        if name not in _BUILDERS:
            raise AttributeError(name)
        table = conform(_BUILDERS[name](self._tables), SOURCES[name])
        setattr(self, name, table)
        return table


def sources_from_testdata(spark: SparkSession, root: str, fine: bool = False) -> TestdataSources:
    return TestdataSources(spark, root, fine)
