"""Closed tours of two, three and four legs over the edge table.

``two_leg_chains`` and ``three_leg_chains`` are the open-ended chain tables. ``build_tours`` does not go through
them: it keeps only legs that can still come home and joins chains from both ends, which gives the same tours.
"""

from __future__ import annotations

from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deadhead import labels
from deadhead.config import DEFAULT, TUNING, Params, Tuning
from deadhead.functions.tables import expanding_join
from deadhead.storage import materialize

LEG_COLUMNS = {
    "origin": "string",
    "dest": "string",
    "leg": "string",
    "dist": "double",
    "leg_dtl": "string",
    "ozip": "string",
    "dzip": "string",
    "loaded_ind": "long",
}
SLOTS = "abcd"
# bounds computed by summing in another order than the exact test may differ in the last bits
SLACK = 1 + 1e-9


def slot_columns(*slots: str) -> list[str]:
    return [f"{s}_{c}" for s in slots for c in LEG_COLUMNS]


TOUR_COLUMNS = [*slot_columns(*SLOTS), "dc_count", "total_dist"]


def campuses(campus_map: DataFrame) -> DataFrame:
    """Distinct DCs that may be the home of a tour."""
    return campus_map.select(F.col("campus_name").alias("dc")).distinct()


def tour_legs(edges: DataFrame) -> DataFrame:
    """Distinct legs in tour terms, with the number of edges (differing in facility types only) behind each.

    Chains of distinct legs that keep all leg columns are distinct, so no chain table is deduplicated.
    """
    return edges.groupBy(
        F.col("o_id").alias("origin"),
        F.col("d_id").alias("dest"),
        "leg",
        "dist",
        "leg_dtl",
        F.col("o_zip").alias("ozip"),
        F.col("d_zip").alias("dzip"),
        "loaded_ind",
    ).agg(F.count(F.lit(1)).alias("copies"))


def _slot(legs: DataFrame, slot: str, *extra: str) -> DataFrame:
    return legs.select(*[F.col(c).alias(f"{slot}_{c}") for c in (*LEG_COLUMNS, *extra)])


def _add(*columns: str) -> Column:
    return reduce(lambda x, y: x + y, [F.col(c) for c in columns])


def _dist(slots: str) -> Column:
    return _add(*[f"{s}_dist" for s in slots])


def _one_loaded(x: str, y: str) -> Column:
    return _add(f"{x}_loaded_ind", f"{y}_loaded_ind") > 0


def _empty(slots: str) -> Column:
    miles = [F.when(F.col(f"{s}_loaded_ind") == 0, F.col(f"{s}_dist")).otherwise(0.0) for s in slots]
    return reduce(lambda x, y: x + y, miles)


def _not_among(column: str, *others: str) -> Column:
    return ~F.col(column).isin(*[F.col(c) for c in others])


def _partner_on(slots: str) -> Column:
    return F.concat(*[F.col(f"{s}_leg") for s in slots]).contains(labels.PARTNER_MARK)


# rules of the third and the fourth leg
_THIRD = ("c_origin", "a_origin", "b_origin", "a_dest"), ("c_dest", "a_dest", "b_dest", "b_origin")
_FOURTH = (
    ("d_origin", "a_origin", "b_origin", "c_origin", "a_dest", "b_dest"),
    ("d_dest", "a_dest", "b_dest", "c_dest", "b_origin", "c_origin"),
)


def _no_revisit(rules: tuple[tuple[str, ...], ...]) -> Column:
    return reduce(lambda x, y: x & y, [_not_among(*rule) for rule in rules])


def two_leg_chains(edges: DataFrame, p: Params = DEFAULT, tuning: Tuning = TUNING) -> DataFrame:
    """All pairs of consecutive legs, at least one loaded, within the mileage cap."""
    legs = tour_legs(edges)
    fits = _one_loaded("a", "b") & (_dist("ab") <= p.max_miles)
    return expanding_join(_slot(legs, "a"), _slot(legs, "b"), [("a_dest", "b_origin")], fits, tuning)


def three_leg_chains(
    chains: DataFrame, edges: DataFrame, p: Params = DEFAULT, tuning: Tuning = TUNING
) -> DataFrame:
    """Open two-leg chains with a third leg that visits no facility again."""
    going = chains.filter(F.col("a_origin") != F.col("b_dest"))
    fits = _one_loaded("b", "c") & _no_revisit(_THIRD) & (_dist("abc") <= p.max_miles)
    return expanding_join(going, _slot(tour_legs(edges), "c"), [("b_dest", "c_origin")], fits, tuning)


def dc_homed(tours: DataFrame) -> DataFrame:
    """Keep tours whose first facility is of a DC type; an unknown type is kept."""
    return tours.filter(_home_type(F.col("a_leg_dtl")))


def _home_type(leg_dtl: Column) -> Column:
    return F.coalesce(F.substring_index(leg_dtl, "-", 1).isin(*labels.DC_TYPES), F.lit(True))


def _way_home(legs: DataFrame, homes: DataFrame) -> DataFrame:
    """Per facility, the shortest one- and two-leg ways to any home: all, and those with a partner leg.

    Two aggregates over the legs; rules other than the distance are ignored, so the values are lower bounds.
    """
    partner = F.col("leg").contains(labels.PARTNER_MARK)
    last = (
        legs.join(homes, legs.dest == homes.dc, "left_semi")
        .groupBy(F.col("origin").alias("node"))
        .agg(F.min("dist").alias("one"), F.min(F.when(partner, F.col("dist"))).alias("one_p"))
    )
    two = (
        legs.join(last, legs.dest == last.node)
        .withColumn("two", F.col("dist") + F.col("one"))
        .withColumn("two_p", F.when(partner, F.col("two")).otherwise(F.col("dist") + F.col("one_p")))
        .groupBy(F.col("origin").alias("node"))
        .agg(F.min("two").alias("two"), F.min("two_p").alias("two_p"))
    )
    return last.select("node", "one").join(two, "node", "full")


def _pad(tours: DataFrame, slots: str, extra: tuple[str, ...]) -> DataFrame:
    types = {**LEG_COLUMNS, **{c: "long" for c in extra}}
    return tours.withColumns({f"{s}_{c}": F.lit(None).cast(t) for s in slots for c, t in types.items()})


class TourBuilder:
    """Closed tours that start at a campus, as wide rows, by shape; each table is built when it is first needed.

    With ``lanes`` each leg carries the numbers of its lane (joined on facilities, so several numbers multiply
    the leg), and with ``rates`` the first leg carries the rates of its home: both are joined to the legs, not
    to the far longer table of tours.
    """

    def __init__(
        self,
        edges: DataFrame,
        campus_set: DataFrame,
        p: Params = DEFAULT,
        tuning: Tuning = TUNING,
        *,
        only_dc_homed: bool = False,
        lanes: DataFrame | None = None,
        rates: DataFrame | None = None,
    ) -> None:
        self.edges, self.p, self.tuning, self.only_dc_homed, self.lanes, self.rates = edges, p, tuning, only_dc_homed, lanes, rates
        self.homes = campus_set.filter(F.col("dc").isNotNull())
        self.extra = ("pair_number",) if lanes is not None else ()
        self.rate_columns = [c for c in rates.columns if c != "dc_nbr"] if rates is not None else []
        self.tail = [*(f"{s}_{c}" for c in self.extra for s in SLOTS), *self.rate_columns]
        self.empty_bound = p.max_empty * p.max_miles * SLACK

    @cached_property
    def legs(self) -> DataFrame:
        # no leg is negative, so a longer one is on no tour
        legs = tour_legs(self.edges).filter(F.col("dist") <= self.p.max_miles)
        if self.lanes is not None:
            numbers = self.lanes.select(F.col("o_id").alias("origin"), F.col("d_id").alias("dest"), "pair_number")
            legs = legs.join(numbers, ["origin", "dest"], "left")
        legs = legs.join(self.homes.select(F.col("dc").alias("dest"), F.lit(1).alias("to_campus")), "dest", "left")
        return materialize(legs.withColumn("to_campus", F.coalesce("to_campus", F.lit(0)).cast("long")), "tour-legs")

    @cached_property
    def first(self) -> DataFrame:
        """Legs that leave a home."""
        first = _slot(self.legs, "a", "to_campus", *self.extra).join(self.homes, F.col("a_origin") == F.col("dc"), "left_semi")
        if self.only_dc_homed:
            first = first.filter(_home_type(F.col("a_leg_dtl")))
        if self.rates is not None:
            first = first.join(self.rates, F.col("a_origin") == F.col("dc_nbr"), "left").drop("dc_nbr")
        return materialize(first, "first-legs")

    @cached_property
    def chains(self) -> DataFrame:
        """Open chains of two legs that can still come home in time."""
        ways = _way_home(self.legs, self.homes)
        onward = self.legs.join(ways, self.legs.dest == ways.node, "left").drop("node")
        # the second leg's class tells whether the first must be a partner leg for that
        partner = F.col("leg").contains(labels.PARTNER_MARK)
        on_own = F.col("one").isNotNull() | F.col("two_p").isNotNull() | (partner & F.col("two").isNotNull())
        second = (
            onward.filter(F.col("one").isNotNull() | F.col("two").isNotNull())
            .withColumn("needs_partner", F.when(on_own, 0).otherwise(1))
            .transform(lambda df: _slot(df, "b", "to_campus", "one", "two", "two_p", "needs_partner", *self.extra))
        )
        # counted and joined, so written once
        second = materialize(second, "second-legs")
        offers = F.when(_partner_on("a"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        start = self.first.withColumn("a_offers", F.explode(offers))
        home_by = F.least(F.col("b_one"), F.when(_partner_on("ab"), F.col("b_two")).otherwise(F.col("b_two_p")))
        open_rules = (
            _one_loaded("a", "b")
            & (F.col("a_origin") != F.col("b_dest"))
            & (_dist("ab") <= self.p.max_miles)
            & (_dist("ab") + home_by <= self.p.max_miles * SLACK)
            & (_empty("ab") <= self.empty_bound)
        )
        chains = expanding_join(
            start, second, [("a_dest", "b_origin"), ("a_offers", "b_needs_partner")], open_rules, self.tuning
        )
        return materialize(chains.drop("a_offers", "b_needs_partner", "b_one", "b_two", "b_two_p"), "chains")

    def two(self) -> DataFrame:
        """Out and straight back: no chain is built."""
        back = _slot(self.legs, "b", *self.extra)
        two = (
            self.first.join(back, (F.col("a_dest") == F.col("b_origin")) & (F.col("a_origin") == F.col("b_dest")))
            .filter(_one_loaded("a", "b"))
            .withColumn("total_dist", _dist("ab"))
            .filter(F.col("total_dist") <= self.p.max_miles)
            .withColumn("dc_count", F.lit(1).cast("long"))
        )
        return _pad(two, "cd", self.extra).select(*TOUR_COLUMNS, *self.tail)

    def three(self) -> DataFrame:
        """Open chains of two legs, closed by a third."""
        closing = _slot(self.legs, "c", *self.extra)
        three = (
            self.chains.join(closing, (F.col("b_dest") == F.col("c_origin")) & (F.col("a_origin") == F.col("c_dest")))
            .filter(_one_loaded("b", "c") & _no_revisit(_THIRD))
            .withColumn("total_dist", _dist("abc"))
            .filter((F.col("total_dist") <= self.p.max_miles) & (F.try_divide(_empty("abc"), F.col("total_dist")) < self.p.max_empty))
            .withColumn("dc_count", F.col("a_to_campus") + F.col("b_to_campus") + 1)
        )
        return _pad(three, "d", self.extra).select(*TOUR_COLUMNS, *self.tail)

    @cached_property
    def returns(self) -> DataFrame:
        """Chains of two legs that end at a home, from where some chain out of that home ends."""
        p, extra = self.p, self.extra
        ends = self.chains.groupBy(F.col("b_dest").alias("node"), F.col("a_origin").alias("home")).agg(
            F.max(_partner_on("ab")).alias("after_partner"), F.min(_dist("ab")).alias("out_miles"), F.min(_empty("ab")).alias("out_empty")
        )
        ends = materialize(ends, "chain-ends")
        third = _slot(self.legs, "c", "to_campus", *extra).join(ends.select("node").distinct(), F.col("c_origin") == F.col("node"), "left_semi")
        fourth = (
            _slot(self.legs, "d", "copies", *extra)
            .join(ends.select("home").distinct(), F.col("d_dest") == F.col("home"), "left_semi")
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("d_copies"))))
            .drop("_copy", "d_copies")
        )
        third, fourth = materialize(third, "third-legs"), materialize(fourth, "fourth-legs")
        rules = _one_loaded("c", "d") & (_dist("cd") <= p.max_miles) & (_empty("cd") <= self.empty_bound)
        returns = expanding_join(third, fourth, [("c_dest", "d_origin")], rules, self.tuning)
        # what no chain out of this home can meet goes before it is written
        fits = (F.col("out_miles") + _dist("cd") <= p.max_miles * SLACK) & (F.col("after_partner") | _partner_on("cd"))
        fits &= F.col("out_empty") + _empty("cd") <= self.empty_bound
        met = returns.join(ends, (F.col("c_origin") == F.col("node")) & (F.col("d_dest") == F.col("home")) & fits)
        return materialize(met.drop(*ends.columns), "returns")

    def four(self) -> DataFrame:
        """Chains that leave home, met by chains that return there.

        They join on both places where they meet, the middle facility and the home. That key is finer than either
        facility, and no three-leg chain is ever stored.
        """
        mid_campuses, total = F.col("a_to_campus") + F.col("b_to_campus") + F.col("c_to_campus"), _dist("abcd")
        rules = (
            _one_loaded("b", "c")
            & _no_revisit(_THIRD + _FOURTH)
            & (F.col("a_origin") != F.col("c_dest"))
            & (_dist("abc") <= self.p.max_miles)
            & (total <= self.p.max_miles)
            & _partner_on("abcd")
            & (F.try_divide(_empty("abcd"), total) < self.p.max_empty)
            & (mid_campuses < self.p.max_mid_campuses)
        )
        four = expanding_join(self.chains, self.returns, [("b_dest", "c_origin"), ("a_origin", "d_dest")], rules, self.tuning)
        return four.withColumns({"total_dist": total, "dc_count": mid_campuses + 1}).select(*TOUR_COLUMNS, *self.tail)

    def all(self) -> DataFrame:
        tours = self.two().unionByName(self.three()).unionByName(self.four())
        return tours.withColumn("mode", F.lit(labels.TOUR_MODE))


def build_tours(edges: DataFrame, campus_set: DataFrame, p: Params = DEFAULT, tuning: Tuning = TUNING, **options) -> DataFrame:
    """All closed tours of a ``TourBuilder`` as one table."""
    return TourBuilder(edges, campus_set, p, tuning, **options).all()
