"""How many weekly loads run on each tour, and what is left to one-way carriers.

The integer model is: whole loads per tour, at least cost net of the one-way cost of the partner lanes covered;
DC -> store lanes ("must cover") are covered exactly, all other lanes at most up to their demand. It is solved
here by rounds over DataFrames: greedy choices, fallback tours, then exchanges for store lanes that are still
short. Lanes and tours stay distributed: the driver sees one count per round. Store lanes that stay short are
reported (``coverable_short`` if any tour covers them), and no plan with such a lane counts as within target.
"""

from __future__ import annotations

import itertools
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deadhead import labels
from deadhead.config import DEFAULT, Params
from deadhead.storage import materialize

SLOTS = "abcd"
# rounds planned on top of each other before the remaining tours and lanes are written again
ROUNDS_PER_WRITE = 3
# tables of chosen tours kept apart before they are written as one
PICKS_PER_WRITE = 30


# ---------------------------------------------------------------- model inputs


def model_lanes(demand: DataFrame) -> DataFrame:
    """Distinct lane number, weekly loads and one-way cost."""
    return demand.select("pair_number", "loads", F.col("ow_cost_per_load").alias("ow_cpl")).distinct()


def model_routes(tours: DataFrame) -> DataFrame:
    """Tours with the lane number of each loaded leg."""
    lanes = [
        F.when(F.col(f"{s}_loaded_ind") == 1, F.col(f"pair_nbr{i}")).alias(f"lane_{i}")
        for i, s in enumerate(SLOTS, start=1)
    ]
    return tours.select("route_nbr", "home_dc", *lanes, "total_dist", F.col("rf_cost").alias("cost"), "mode")


def _is_must_cover() -> Column:
    return F.col("o_type").isin(*labels.DC_TYPES) & F.col("d_type").isin(labels.STORE_TYPE)


def _is_partner() -> Column:
    return F.col("leg").startswith(labels.PARTNER_MARK)


def must_cover(demand: DataFrame) -> DataFrame:
    return demand.filter(_is_must_cover()).select("pair_number").distinct()


def partner_lanes(demand: DataFrame) -> DataFrame:
    return demand.filter(_is_partner()).select("pair_number").distinct()


def lane_model(demand: DataFrame) -> DataFrame:
    """One row per lane number: loads, one-way cost, and the two roles.

    A number may stand for several demand rows; the cheapest one-way cost and then the most loads are taken.
    Rows without a number are left out.
    """
    pick = F.min(F.struct(F.col("ow_cost_per_load").alias("cost"), (-F.col("loads")).alias("less")))
    return (
        demand.filter(F.col("pair_number").isNotNull())
        .groupBy(F.col("pair_number").alias("lane"))
        .agg(
            pick.alias("pick"),
            F.coalesce(F.max(_is_must_cover()), F.lit(False)).alias("must_cover"),
            F.coalesce(F.max(_is_partner()), F.lit(False)).alias("partner"),
        )
        .select(
            "lane",
            F.round(-F.col("pick.less")).cast("long").alias("demand"),
            F.col("pick.cost").alias("ow_cpl"),
            "must_cover",
            "partner",
        )
    )


def incidence(routes: DataFrame) -> DataFrame:
    """One row per tour and lane it covers; a lane driven twice by one tour counts once."""
    lanes = F.array_distinct(F.array_compact(F.array(*[F.col(f"lane_{i}") for i in range(1, 5)])))
    return routes.select("route_nbr", F.explode(lanes).alias("lane"))


def net_cost(routes: DataFrame, lanes: DataFrame) -> DataFrame:
    """Tour cost less the one-way cost of its partner lanes."""
    partner = lanes.filter("partner").select("lane", "ow_cpl")
    credit = incidence(routes).join(partner, "lane").groupBy("route_nbr").agg(F.sum("ow_cpl").alias("credit"))
    return (
        routes.select("route_nbr", "cost")
        .join(credit, "route_nbr", "left")
        .withColumn("net", F.col("cost") - F.coalesce("credit", F.lit(0.0)))
        .select("route_nbr", "cost", "net")
    )


def uncovered(routes: DataFrame, lanes: DataFrame) -> DataFrame:
    """Must-cover lanes with loads but no tour: each makes the exact model infeasible."""
    needed = lanes.filter(F.col("must_cover") & (F.col("demand") > 0)).select("lane", "demand")
    return needed.join(incidence(routes), "lane", "left_anti")


def lane_issues(routes: DataFrame, demand: DataFrame) -> DataFrame:
    """One row of counts of lanes the model cannot take literally."""
    lanes = demand.groupBy("pair_number").agg(F.count(F.lit(1)).alias("n"))
    counted = lanes.agg(
        F.count(F.when(F.col("pair_number").isNotNull() & (F.col("n") > 1), 1)).alias("repeated_lanes"),
        F.coalesce(F.sum(F.when(F.col("pair_number").isNull(), F.col("n"))), F.lit(0)).alias("unnumbered_rows"),
    )
    known = demand.select(F.col("pair_number").alias("lane"))
    orphans = incidence(routes).select("lane").distinct().join(known, "lane", "left_anti")
    return counted.crossJoin(orphans.agg(F.count(F.lit(1)).alias("lanes_without_demand")))


# ---------------------------------------------------------------- assignment


def candidates(routes: DataFrame, lanes: DataFrame) -> DataFrame:
    """Tours as model columns: ``net``, the constrained lanes in ``l1..l4``, their number and the must-cover ones.

    Lane numbers without demand do not constrain a tour; a tour without any constrained lane is left out, as
    nothing would bound its loads.
    """
    on = incidence(routes).join(lanes, "lane")
    per_tour = on.groupBy("route_nbr").agg(
        F.sort_array(F.collect_list("lane")).alias("on"),
        F.sort_array(F.collect_list(F.when(F.col("must_cover"), F.col("lane")))).alias("must"),
        F.sum(F.when(F.col("partner"), F.col("ow_cpl"))).alias("credit"),
        F.min("demand").alias("room"),
    )
    joined = routes.select("route_nbr", "cost").join(per_tour, "route_nbr")
    return joined.select(
        "route_nbr",
        "cost",
        (F.col("cost") - F.coalesce("credit", F.lit(0.0))).alias("net"),
        "on",
        "must",
        F.size("on").alias("n"),
        "room",
    )


def fallback_tours(cands: DataFrame) -> DataFrame:
    """Per must-cover lane, the cheapest tour that covers nothing else."""
    single = cands.filter((F.col("n") == 1) & (F.size("must") == 1))
    best = F.min(F.struct("net", "route_nbr"))
    return (
        single.groupBy(F.col("on")[0].alias("lane"))
        .agg(best.alias("best"))
        .select("lane", F.col("best.net").alias("base"), F.col("best.route_nbr").alias("route_nbr"))
    )


def lane_values(cands: DataFrame) -> DataFrame:
    """What covering one load of a must-cover lane is worth.

    The cost of the fallback tour it replaces or, without a fallback, the dearest tour of the lane: any fixed
    value is exact there, as such a lane's loads must come from these tours in full.
    """
    dearest = (
        cands.select(F.explode("must").alias("lane"), "net").groupBy("lane").agg(F.max("net").alias("dearest"))
    )
    return dearest.join(fallback_tours(cands), "lane", "left").select(
        "lane",
        F.coalesce("base", "dearest").alias("value"),
        F.col("base").isNull().alias("no_fallback"),
        "route_nbr",
    )


def gains(cands: DataFrame, values: DataFrame) -> DataFrame:
    """Tours worth considering beside the fallbacks, the best one per set of lanes: ``urgent, gain, on``."""
    worth = (
        cands.select("route_nbr", F.explode("must").alias("lane"))
        .join(values.select("lane", "value", "no_fallback"), "lane")
        .groupBy("route_nbr")
        .agg(F.sum("value").alias("worth"), F.max("no_fallback").alias("no_fallback"))
    )
    scored = (
        cands.filter(F.col("room") > 0)
        .join(worth, "route_nbr", "left")
        .select(
            "route_nbr",
            "on",
            F.coalesce("no_fallback", F.lit(False)).cast("int").alias("urgent"),
            (F.coalesce("worth", F.lit(0.0)) - F.col("net")).alias("gain"),
        )
        .filter((F.col("gain") > 0) | (F.col("urgent") == 1))
    )
    best = F.max(F.struct("urgent", "gain", (-F.col("route_nbr")).alias("order")))
    return scored.groupBy("on").agg(best.alias("best")).select("on", "best.*")


def greedy_rounds(scored: DataFrame, lanes: DataFrame) -> DataFrame:
    """Loads of tours chosen in locally dominant order, ``route_nbr, loads, gain``.

    In each round every lane names its best remaining tour, and a tour named by all its lanes runs with the
    least remaining loads among them. The order (urgent, gain, lowest number) is total, so the outcome equals
    taking the tours one by one in that order. Each choice uses up a lane, whose other tours then drop out;
    only the best tour per lane is ever grouped, by a map-side combined maximum.
    """
    spark = scored.sparkSession
    scored = materialize(scored, "scored")
    most_lanes = scored.agg(F.max(F.size("on"))).first()[0] or 0
    slots = [f"l{i + 1}" for i in range(most_lanes)]
    wide = scored.select(
        "urgent", "gain", "order", F.size("on").alias("n"), *[F.get("on", F.lit(i)).alias(s) for i, s in enumerate(slots)]
    )
    if not slots:
        return spark.createDataFrame([], "route_nbr long, loads long, gain double")
    alive = wide
    left = materialize(lanes.filter(F.col("demand") > 0).select("lane", F.col("demand").alias("left")), "lanes-left")
    picked: list[DataFrame] = []
    for round_nbr in itertools.count(1):  # ends: each round with a choice uses up a lane
        named = (
            alive.select("urgent", "gain", "order", "n", F.explode(F.array_compact(F.array(*slots))).alias("lane"))
            .groupBy("lane")
            .agg(F.max(F.struct("urgent", "gain", "order", "n")).alias("best"))
        )
        chosen = (
            named.join(left, "lane")
            .groupBy("best")
            .agg(F.collect_list("lane").alias("on"), F.min("left").alias("loads"))
            .filter(F.size("on") == F.col("best.n"))
            .select((-F.col("best.order")).alias("route_nbr"), "loads", F.col("best.gain").alias("gain"), "on")
        )
        chosen = materialize(chosen, "chosen")
        picked.append(chosen.drop("on"))
        if chosen.isEmpty():
            break
        used = chosen.select(F.explode("on").alias("lane"), "loads")
        after = left.join(used, "lane", "left").select(
            "lane", (F.col("left") - F.coalesce("loads", F.lit(0))).alias("left")
        )
        spent = after.filter(F.col("left") == 0).select("lane")
        for slot in slots:
            alive = alive.join(spent.select(F.col("lane").alias(slot)), slot, "left_anti")
        left = after.filter(F.col("left") > 0)
        if round_nbr % ROUNDS_PER_WRITE == 0:
            alive, left = materialize(alive, "tours-alive"), materialize(left, "lanes-left")
        if len(picked) == PICKS_PER_WRITE:
            picked = [materialize(_union(picked), "picked")]
    return _union(picked)


def _union(tables: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, tables)


def assign_loads(routes: DataFrame, lanes: DataFrame) -> DataFrame:
    """Whole loads per tour, ``route_nbr, loads``: greedy rounds, fallback tours for what is left to cover, and
    exchanges for store lanes without a fallback."""
    cands = materialize(candidates(routes, lanes), "candidates")
    values = materialize(lane_values(cands), "lane-values")
    runs = greedy_rounds(gains(cands, values), lanes).select("route_nbr", "loads")
    runs = materialize(runs, "greedy-runs")
    return exchanged(cands, materialize(runs.unionByName(fallback_runs(cands, values, runs, lanes)), "runs"), lanes)


def fallback_runs(cands: DataFrame, values: DataFrame, runs: DataFrame, lanes: DataFrame) -> DataFrame:
    """Fallback tours for the must-cover loads that ``runs`` leave."""
    covered = (
        cands.join(runs, "route_nbr")
        .select(F.explode("must").alias("lane"), "loads")
        .groupBy("lane")
        .agg(F.sum("loads").alias("covered"))
    )
    rest = (
        values.filter("route_nbr is not null")
        .join(lanes.select("lane", "demand"), "lane")
        .join(covered, "lane", "left")
        .withColumn("loads", F.col("demand") - F.coalesce("covered", F.lit(0)))
    )
    return rest.filter(F.col("loads") > 0).select("route_nbr", "loads")


def _left(cands: DataFrame, runs: DataFrame, lanes: DataFrame) -> DataFrame:
    """Loads of each lane that no tour carries."""
    used = cands.select("route_nbr", F.explode("on").alias("lane")).join(runs, "route_nbr").groupBy("lane").agg(F.sum("loads").alias("used"))
    return lanes.join(used, "lane", "left").select("lane", "must_cover", (F.col("demand") - F.coalesce("used", F.lit(0))).alias("left"))


def exchanged(cands: DataFrame, runs: DataFrame, lanes: DataFrame) -> DataFrame:
    """``runs`` with loads moved between tours until no short store lane can be helped any more.

    A short store lane takes a load on one of its tours. Where the tour's other lane is full, a load of another
    store lane on it makes room, and that store lane looks for another tour in turn, until one has room. The search goes out from
    all short lanes at once, each store lane being reached from one of them, so chains never meet at a store lane;
    one chain per free lane is carried out. If no chain ends, none exists: for tours of one store lane and at most
    one other lane, the plan then covers all that any plan can. Tours with more lanes only take what is free.
    Each round lowers the missing loads, so the rounds end.
    """
    change = "struct<route_nbr:long,step:int>"
    own = cands.filter(F.size("must") == 1).select("route_nbr", "net", F.col("must")[0].alias("store"), F.array_except("on", "must").alias("others"))
    own = materialize(own, "exchange-tours")
    simple = own.filter(F.size("others") == 1).select("route_nbr", "store", F.col("others")[0].alias("other"))
    while True:
        left = materialize(_left(cands, runs, lanes), "exchange-left")
        short = left.filter(F.col("must_cover") & (F.col("left") > 0)).select(F.col("lane").alias("store"), "left")
        short = short.join(own.select("store").distinct(), "store")
        front = short.select("store", F.col("store").alias("root"), F.col("left").alias("flow"), F.expr(f"cast(array() as array<{change}>)").alias("chain"))
        front = materialize(front, "exchange-front")
        reached = front.select("store")
        free = left.select(F.col("lane").alias("other"), "left")
        moves = None
        while moves is None and not front.isEmpty():
            # tours of the lanes reached whose other lanes all have room
            room = (
                front.join(own, "store")
                .select("root", "flow", "chain", "route_nbr", "net", F.explode_outer("others").alias("other"))
                .join(free, "other", "left")
                .groupBy("root", "chain", "route_nbr", "net", "flow")
                .agg(F.min(F.when(F.col("other").isNull(), F.col("flow")).otherwise(F.col("left"))).alias("room"), F.collect_list("other").alias("others"))
                .filter("room > 0")
            )
            best = F.min(F.struct("net", "route_nbr", F.least("flow", "room").alias("flow"), "chain", "others")).alias("best")
            ends = room.groupBy("root").agg(best).select("root", "best.*")
            # a free lane serves one chain in a round: that of the smallest root
            claims = ends.select("root", F.explode("others").alias("other")).groupBy("other").agg(F.min("root").alias("winner"))
            lost = ends.select("root", F.explode("others").alias("other")).join(claims, "other").filter("root <> winner").select("root")
            ends = materialize(ends.join(lost, "root", "left_anti"), "exchange-ends")
            if not ends.isEmpty():
                moves = ends.select("flow", F.explode(F.concat("chain", F.array(F.expr("named_struct('route_nbr', route_nbr, 'step', 1)")))).alias("m"))
                break
            taken = runs.join(simple, "route_nbr").select(F.col("route_nbr").alias("out"), "loads", F.col("store").alias("next"), "other")
            steps = (
                front.join(simple, "store")
                .join(taken, "other")
                .join(reached.select(F.col("store").alias("next")), "next", "left_anti")
                .select(
                    "next", "root", F.least("flow", "loads").alias("flow"),
                    F.concat("chain", F.array(F.expr("named_struct('route_nbr', route_nbr, 'step', 1)"), F.expr("named_struct('route_nbr', out, 'step', -1)"))).alias("chain"),
                )
            )
            front = materialize(
                steps.groupBy(F.col("next").alias("store")).agg(F.min(F.struct("root", (-F.col("flow")).alias("less"), "chain")).alias("best"))
                .select("store", "best.root", (-F.col("best.less")).alias("flow"), "best.chain"),
                "exchange-front",
            )
            reached = reached.unionByName(front.select("store"))
        if moves is None:
            return runs
        moved = moves.select(F.col("m.route_nbr").alias("route_nbr"), (F.col("flow") * F.col("m.step")).alias("loads"))
        after = runs.unionByName(moved).groupBy("route_nbr").agg(F.sum("loads").alias("loads")).filter("loads > 0")
        runs = materialize(after, "runs")


# ---------------------------------------------------------------- distance to the optimum


def _reprice(pairs: DataFrame, prices: DataFrame | None, given: str, wanted: str) -> DataFrame:
    """Least prices of the ``wanted`` lanes that pay for every tour, the ``given`` lanes' prices being fixed."""
    rest = F.col("gain")
    pairs = pairs.filter(F.col(wanted).isNotNull())
    if prices is not None:
        pairs = pairs.join(prices.withColumnsRenamed({"lane": given, "price": "paid"}), given, "left")
        rest = rest - F.coalesce("paid", F.lit(0.0))
    return pairs.groupBy(F.col(wanted).alias("lane")).agg(F.greatest(F.max(rest), F.lit(0.0)).alias("price"))


def optimality_gap(routes: DataFrame, lanes: DataFrame, runs: DataFrame, p: Params = DEFAULT, prices: DataFrame | None = None) -> DataFrame:
    """One row: the objective, a lower bound on it for any plan, and the relative gap.

    By duality, prices per load of each lane that pay for the gain of every tour bound the total gain by the
    prices times the loads. A tour is charged to one store lane and one other lane. Three sets of prices are
    tried, the other lanes first, the store lanes first, and the least gain taken on each used-up store lane,
    and a fourth from ``prices`` (lane, price) of the other lanes, as price rounds leave them; the best bound is kept. Store lanes that no tour covers are not part of the comparison. A plan that leaves
    a coverable store lane short breaks a rule of the model; its objective is no better for that, so it is never within target.
    """
    cands = materialize(candidates(routes, lanes), "candidates")
    values = materialize(lane_values(cands), "lane-values")
    scored = gains(cands, values)
    side = scored.select((-F.col("order")).alias("route_nbr"), "gain", F.explode("on").alias("lane")).join(
        lanes.select("lane", "must_cover"), "lane"
    )
    pairs = side.groupBy("route_nbr", "gain").agg(
        F.max(F.when(F.col("must_cover"), F.col("lane"))).alias("store"),
        F.max(F.when(~F.col("must_cover"), F.col("lane"))).alias("other"),
    )
    pairs = materialize(pairs, "tour-lanes")
    used_up = (
        pairs.join(runs, "route_nbr")
        .groupBy(F.col("store").alias("lane"))
        .agg(F.sum("loads").alias("loads"), F.min("gain").alias("price"))
        .join(lanes, "lane")
        .filter(F.col("loads") == F.col("demand"))
        .select("lane", F.greatest("price", F.lit(0.0)).alias("price"))
    )

    def priced(first: DataFrame, given: str, wanted: str) -> DataFrame:
        return first.unionByName(_reprice(pairs, first, given, wanted))

    tries = [
        priced(_reprice(pairs, None, "store", "other"), "other", "store"),
        priced(_reprice(pairs, None, "other", "store"), "store", "other"),
        priced(_reprice(pairs, used_up, "store", "other"), "other", "store"),
    ]
    if prices is not None:
        # other lanes alone pay for tours without a store lane
        alone = pairs.filter(F.col("store").isNull() & F.col("other").isNotNull()).select(F.col("other").alias("lane"), F.col("gain").alias("price"))
        lifted = prices.select("lane", "price").unionByName(alone).groupBy("lane").agg(F.greatest(F.max("price"), F.lit(0.0)).alias("price"))
        tries.append(priced(materialize(lifted, "lane-prices"), "other", "store"))
    room = lanes.select("lane", "demand")
    best = F.lit(None).cast("double")
    row = run_audit(routes, lanes, runs).select("objective", "coverable_short")
    row = row.crossJoin(
        values.join(room, "lane").agg(F.coalesce(F.sum(F.col("value") * F.col("demand")), F.lit(0.0)).alias("plain"))
    )
    for i, prices in enumerate(tries):
        worth = F.coalesce(F.sum(F.col("price") * F.col("demand")), F.lit(0.0)).alias(f"worth{i}")
        row = row.crossJoin(prices.join(room, "lane").agg(worth))
        best = F.least(best, F.col(f"worth{i}"))
    row = row.select("objective", (F.col("plain") - best).alias("bound"), "coverable_short")
    apart = F.col("objective") - F.col("bound")
    near = apart <= p.target_gap * F.abs("objective")
    return row.select(
        "objective", "bound", F.try_divide(apart, F.abs("objective")).alias("gap"), "coverable_short", ((F.col("coverable_short") == 0) & near).alias("within_target")
    )


# ---------------------------------------------------------------- checks and results


def lane_audit(routes: DataFrame, lanes: DataFrame, runs: DataFrame) -> DataFrame:
    """Per lane: loads on tours, what is left, and whether the rules hold."""
    used = incidence(routes).join(runs, "route_nbr").groupBy("lane").agg(F.sum("loads").alias("used"))
    return lanes.join(used, "lane", "left").select(
        "lane",
        "must_cover",
        "demand",
        F.coalesce("used", F.lit(0)).alias("dedicated"),
        (F.col("demand") - F.coalesce("used", F.lit(0))).alias("one_way"),
        (F.coalesce("used", F.lit(0)) > F.col("demand")).alias("over"),
        (F.col("must_cover") & (F.coalesce("used", F.lit(0)) < F.col("demand"))).alias("short"),
    )


def run_audit(routes: DataFrame, lanes: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: objective, broken rules, and loads that are not whole positive numbers.

    ``coverable_short`` counts the short lanes that some tour covers, apart from those of ``uncovered``.
    """
    on_tour = incidence(routes).select("lane", F.lit(True).alias("on_tour")).distinct()
    per_lane = lane_audit(routes, lanes, runs).join(on_tour, "lane", "left").agg(
        F.count(F.when(F.col("over"), 1)).alias("lanes_over"),
        F.count(F.when(F.col("short"), 1)).alias("lanes_short"),
        F.count(F.when(F.col("short") & F.col("on_tour"), 1)).alias("coverable_short"),
        F.coalesce(F.sum(F.when(F.col("short"), F.col("one_way"))), F.lit(0)).alias("loads_short"),
    )
    per_tour = (
        net_cost(routes, lanes)
        .join(runs, "route_nbr")
        .agg(
            F.coalesce(F.sum(F.col("loads") * F.col("net")), F.lit(0.0)).alias("objective"),
            F.count(F.when((F.col("loads") < 0) | (F.col("loads") != F.floor("loads")), 1)).alias("bad_loads"),
        )
    )
    return per_lane.crossJoin(per_tour)


def one_way_loads(routes: DataFrame, lanes: DataFrame, runs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """Loads left to one-way carriers per lane, non-zero only."""
    return (
        lane_audit(routes, lanes, runs)
        .filter(F.col("one_way") != 0)
        .select(
            F.col("lane").cast("string").alias("pair_number"),
            F.col("one_way").alias("loads"),
            F.lit(p.description).alias("description"),
        )
    )


def dedicated_plan(routes: DataFrame, runs: DataFrame, stamp: datetime, p: Params = DEFAULT) -> DataFrame:
    """The chosen tours with cost, miles and the run stamp."""
    details = routes.select(
        "route_nbr", "home_dc", F.col("cost"), F.col("total_dist").alias("dist"), "mode"
    )
    return (
        runs.filter(F.col("loads") != 0)
        .withColumn("description", F.lit(p.description))
        .join(details, "route_nbr", "left")
        .withColumns({"run_date": F.lit(f"{stamp:%Y-%m-%d}"), "run_time": F.lit(f"{stamp:%H:%M}")})
    )


def cost_summary(routes: DataFrame, lanes: DataFrame, runs: DataFrame, p: Params = DEFAULT) -> DataFrame:
    """One row: cost on tours, cost of one-way loads, and the model objective."""
    tours = (
        net_cost(routes, lanes)
        .join(runs, "route_nbr")
        .agg(
            F.sum(F.col("loads") * F.col("cost")).alias("dedicated_cost"),
            F.sum(F.col("loads") * F.col("net")).alias("total_cost"),
        )
    )
    rest = (
        lane_audit(routes, lanes, runs)
        .join(lanes.select("lane", "ow_cpl"), "lane")
        .agg(F.sum(F.col("one_way") * F.col("ow_cpl")).alias("ow_cost"))
    )
    return tours.crossJoin(rest).select(
        F.lit(None).cast("string").alias("region"),
        "dedicated_cost",
        "ow_cost",
        "total_cost",
        F.lit(p.description).alias("description"),
    )


def run_counts(routes: DataFrame, lanes: DataFrame, runs: DataFrame) -> DataFrame:
    """One row: lanes, candidate tours, chosen tours, one-way lanes."""
    left = lane_audit(routes, lanes, runs).agg(
        F.count(F.lit(1)).alias("demand_lanes"), F.count(F.when(F.col("one_way") != 0, 1)).alias("one_way_lanes")
    )
    choices = routes.agg(F.count(F.lit(1)).alias("route_choices"))
    chosen = runs.agg(F.count(F.when(F.col("loads") != 0, 1)).alias("routes_chosen"))
    return left.crossJoin(choices).crossJoin(chosen).select(
        "demand_lanes", "route_choices", "routes_chosen", "one_way_lanes"
    )
