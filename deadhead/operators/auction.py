"""Loads for tours by price rounds, with a certified distance to the best plan.

Store lanes bid for other lanes (mostly partner lanes). A load of a store lane gains by a tour over its fallback tour; a
store lane bids for all its free loads at once, on the lanes that are worth most to it at current prices, as high as makes
its next choice as good, plus ``step``, and lifts the loads it holds to the same level. It sees other store lanes' loads only,
so however many loads it has, they never outbid each other. A lane keeps its highest bids up to its loads; outbid loads are
free again, and the least bid that a full lane keeps is its price.
Prices begin at what the lane's own tours without a store lane gain, so a lane that is not full never costs more than that.
Rounds end when no free load finds a lane worth its price. Then every load has a choice within ``step`` of its best one, so
the plan's gain is within ``step`` for each store load of the best plan's, and the prices prove it.

Prices, bids and loads are tables; the driver sees one count per round. Where no lane is scarce, or the loads of a store lane
exceed the lanes it can use, few rounds are needed, however many lanes and loads there are; where store lanes of few loads
compete for scarce lanes of about the same worth, prices climb by the step.
"""

from __future__ import annotations

import itertools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deadhead.config import DEFAULT, Params
from deadhead.operators import matching
from deadhead.storage import materialize

#: The step as a share of the greatest gain of a tour, at least: keeps rounds few where costs cancel out.
LEAST_STEP = 1e-4
HELD = "store long, other long, gain double, bid double, loads long, route_nbr long"


@dataclass(frozen=True)
class Market:
    """Tables of the model: best tour per pair of lanes, reserve prices, store lanes with what their loads are worth."""

    pairs: DataFrame  # store, other, gain, route_nbr
    reserve: DataFrame  # other, price, route_nbr (of the best tour without a store lane, if it gains), room
    stores: DataFrame  # store, demand
    others: DataFrame  # on, gain, route_nbr of tours with more lanes
    step: float


def _parted(scored: DataFrame, lanes: DataFrame) -> DataFrame:
    """Scored tours with their store and other lane, and the numbers of both."""
    on = scored.select((-F.col("order")).alias("route_nbr"), "gain", "urgent", "on", F.explode("on").alias("lane")).join(lanes.select("lane", "must_cover"), "lane")
    return on.groupBy("route_nbr", "gain", "urgent", "on").agg(
        F.max(F.when(F.col("must_cover"), F.col("lane"))).alias("store"),
        F.max(F.when(~F.col("must_cover"), F.col("lane"))).alias("other"),
        F.count(F.when(F.col("must_cover"), 1)).alias("n_stores"),
        F.count(F.when(~F.col("must_cover"), 1)).alias("n_others"),
    )


def market(cands: DataFrame, values: DataFrame, lanes: DataFrame, p: Params = DEFAULT) -> Market:
    """The model's tables. Loads of store lanes without a fallback tour gain so much more that they go first."""
    room = lanes.filter(F.col("demand") > 0)
    tours = materialize(_parted(matching.gains(cands, values), room), "market-tours")
    simple = (F.col("n_stores") <= 1) & (F.col("n_others") <= 1)
    most = tours.agg(F.coalesce(F.max(F.abs("gain")), F.lit(0.0))).first()[0]
    pairs = tours.filter(simple & F.col("store").isNotNull() & F.col("other").isNotNull())
    pairs = pairs.select("store", "other", (F.col("gain") + F.col("urgent") * (most + 1.0)).alias("gain"), "route_nbr")
    alone = tours.filter(simple & F.col("store").isNull()).select("other", F.col("gain").alias("price"), "route_nbr")
    reserve = room.filter(~F.col("must_cover")).select(F.col("lane").alias("other"), F.col("demand").alias("room")).join(alone, "other", "left")
    reserve = reserve.select("other", F.coalesce("price", F.lit(0.0)).alias("price"), "route_nbr", "room")
    pairs = materialize(pairs, "market-pairs")
    stores = room.select(F.col("lane").alias("store"), "demand").join(pairs.select("store").distinct(), "store")
    stores = materialize(stores, "market-stores")
    needed = values.join(room, "lane").agg(F.sum(F.col("value") * F.col("demand")), F.sum("demand")).first()
    mean = abs(needed[0]) / needed[1] if needed[1] else 0.0
    step = max(p.target_gap * mean / 4, LEAST_STEP * most, 1e-9)
    return Market(pairs, materialize(reserve, "market-reserve"), stores, tours.filter(~simple).select("on", "gain", "route_nbr", "urgent"), step)


def _offered(m: Market, held: DataFrame) -> DataFrame:
    """Per other lane its price, and what it is to the store lane that holds the cheapest loads: the least bid of all others."""
    own = held.groupBy("other", "store").agg(F.min("bid").alias("least"), F.sum("loads").alias("loads"))
    lanes = own.groupBy("other").agg(F.sum("loads").alias("sold"), F.min(F.struct("least", "store")).alias("first"))
    lanes = lanes.select("other", "sold", F.col("first.least").alias("least"), F.col("first.store").alias("holder"))
    rest = own.join(lanes.select("other", "holder"), "other").filter("store <> holder").groupBy("other").agg(F.min("least").alias("second"))
    lanes = m.reserve.select("other", F.col("price").alias("floor"), "room").join(lanes, "other", "left").join(rest, "other", "left")
    full = F.coalesce(F.col("sold") == F.col("room"), F.lit(False))

    def price(bid: str) -> Column:
        return F.when(full, F.greatest(bid, "floor")).otherwise(F.col("floor"))

    return lanes.select("other", "room", "floor", full.alias("full"), "holder", price("least").alias("price"), price("second").alias("to_holder"))


def _bids(m: Market, held: DataFrame, offered: DataFrame) -> DataFrame:
    """Bids of each store lane with free loads, on the lanes that are worth most to it, as many as its loads need.

    A store lane never bids against itself: it sees the loads and bids of others. Lanes that it takes whole it bids for
    up to what its next load could still get, the last one up to the next lane. ``level`` is what that next load gains.
    """
    used = held.groupBy("store").agg(F.sum("loads").alias("used"))
    free = m.stores.join(used, "store", "left").select("store", (F.col("demand") - F.coalesce("used", F.lit(0))).alias("free")).filter("free > 0")
    own = held.groupBy("store", "other").agg(F.sum("loads").alias("own"))
    worth = m.pairs.join(free, "store").join(offered, "other").join(own, ["store", "other"], "left").select(
        "store", "other", "gain", "route_nbr", "free",
        (F.col("room") - F.coalesce("own", F.lit(0))).alias("room"),
        (F.col("gain") - F.when(F.col("store") == F.col("holder"), F.col("to_holder")).otherwise(F.col("price"))).alias("worth"),
    ).filter("room > 0 and worth > 0")
    store = Window.partitionBy("store")
    by_worth = store.orderBy(F.desc("worth"), "route_nbr")
    ranked = worth.select(
        "*", F.sum("room").over(by_worth.rowsBetween(Window.unboundedPreceding, 0)).alias("through"), F.lead("worth", 1, 0.0).over(by_worth).alias("next")
    )
    ranked = ranked.withColumn("level", F.coalesce(F.max(F.when(F.col("through") > F.col("free"), F.col("worth"))).over(store), F.lit(0.0)))
    before = F.col("through") - F.col("room")
    mark = F.when(F.col("through") <= F.col("free"), F.col("level")).otherwise(F.col("next"))
    return ranked.filter(before < F.col("free")).select(
        "store", "other", "gain", _up_to(F.col("gain"), mark, m.step).alias("bid"), F.least("room", F.col("free") - before).alias("loads"), "route_nbr", "level"
    )


def _up_to(gain: Column, mark: Column, step: float) -> Column:
    """The bid that leaves a load a step less than ``mark``; nobody pays more than the load gains."""
    return F.least(gain - mark + F.lit(step), gain)


def _lifted(m: Market, held: DataFrame, bids: DataFrame) -> DataFrame:
    """Loads held, those of bidding store lanes at the level of the bids: all of their loads are worth the same to them."""
    level = bids.select("store", "level").distinct()
    bid = F.greatest("bid", _up_to(F.col("gain"), F.col("level"), m.step))
    return held.join(level, "store", "left").withColumn("bid", F.when(F.col("level").isNull(), F.col("bid")).otherwise(bid)).drop("level")


def _kept(m: Market, offers: DataFrame) -> DataFrame:
    """The highest offers of each lane up to its loads, the last one in part."""
    by_bid = Window.partitionBy("other").orderBy(F.desc("bid"), "store", "route_nbr")
    before = F.sum("loads").over(by_bid.rowsBetween(Window.unboundedPreceding, -1))
    rest = F.col("room") - F.coalesce(before, F.lit(0))
    kept = offers.join(m.reserve.select("other", "room"), "other").withColumn("loads", F.least("loads", rest)).filter("loads > 0")
    return kept.select("store", "other", "gain", "bid", "loads", "route_nbr")


def _final_prices(m: Market, held: DataFrame, offered: DataFrame) -> DataFrame:
    """Prices at the end: a store lane pays for all its loads what leaves it the gain of its worst one, none if some stay free.

    A lane that one store lane filled early, when others were cheap too, may still be held at a low bid.
    """
    prices = offered.select("other", "price")
    gained = held.join(prices, "other").groupBy("store").agg(F.sum("loads").alias("used"), F.min(F.col("gain") - F.col("price")).alias("least"))
    gained = gained.join(m.stores, "store").select("store", F.when(F.col("used") == F.col("demand"), F.col("least")).otherwise(0.0).alias("level"))
    paid = held.join(gained, "store").groupBy("other").agg(F.min(F.greatest("bid", F.col("gain") - F.col("level"))).alias("paid"))
    price = F.when(F.col("full"), F.greatest("paid", "floor")).otherwise(F.col("floor"))
    return offered.join(paid, "other", "left").select(F.col("other").alias("lane"), price.alias("price"))


def price_rounds(m: Market) -> tuple[DataFrame, DataFrame]:
    """Loads held (store, other, gain, bid, loads, route_nbr) and the final price of each other lane (lane, price)."""
    spark = m.pairs.sparkSession
    held = spark.createDataFrame([], HELD)
    for _ in itertools.count():  # ends: a bid on a full lane raises a load's price by the step, up to the gain of a tour
        offered = materialize(_offered(m, held), "market-prices")
        bids = materialize(_bids(m, held, offered), "market-bids")
        if bids.isEmpty():
            return held, _final_prices(m, held, offered)
        # one store lane's offers at one price are one
        offers = _lifted(m, held, bids).unionByName(bids.drop("level")).groupBy("store", "other", "bid")
        offers = offers.agg(F.max("gain").alias("gain"), F.sum("loads").alias("loads"), F.min("route_nbr").alias("route_nbr"))
        held = materialize(_kept(m, offers), "market-held")


@dataclass(frozen=True)
class Outcome:
    runs: DataFrame  # route_nbr, loads
    prices: DataFrame  # lane, price of the lanes that are not store lanes
    step: float


def assign_by_prices(routes: DataFrame, lanes: DataFrame, p: Params = DEFAULT) -> Outcome:
    """Whole loads per tour by price rounds, the lanes' own tours on what is unsold, tours of more lanes on what is left,
    fallback tours for the rest of the store lanes, and exchanges for store lanes without one."""
    cands = materialize(matching.candidates(routes, lanes), "candidates")
    values = materialize(matching.lane_values(cands), "lane-values")
    m = market(cands, values, lanes, p)
    held, prices = price_rounds(m)
    sold = held.groupBy("route_nbr").agg(F.sum("loads").alias("loads"))
    if not m.others.isEmpty():
        used = held.select(F.explode(F.array("store", "other")).alias("lane"), "loads").groupBy("lane").agg(F.sum("loads").alias("used"))
        rest = lanes.join(used, "lane", "left").withColumn("demand", F.col("demand") - F.coalesce("used", F.lit(0))).drop("used")
        scored = m.others.select("on", "urgent", "gain", (-F.col("route_nbr")).alias("order"))
        unsold = m.reserve.filter("route_nbr is not null and price > 0").select(F.array("other").alias("on"), F.lit(0).alias("urgent"), F.col("price").alias("gain"), (-F.col("route_nbr")).alias("order"))
        more = matching.greedy_rounds(scored.unionByName(unsold), rest).select("route_nbr", "loads")
    else:
        used = held.groupBy("other").agg(F.sum("loads").alias("used"))
        more = m.reserve.filter("route_nbr is not null and price > 0").join(used, "other", "left").select("route_nbr", (F.col("room") - F.coalesce("used", F.lit(0))).alias("loads")).filter("loads > 0")
    runs = materialize(sold.unionByName(more), "priced-runs")
    runs = materialize(runs.unionByName(matching.fallback_runs(cands, values, runs, lanes)), "runs")
    return Outcome(matching.exchanged(cands, runs, lanes), prices, m.step)
