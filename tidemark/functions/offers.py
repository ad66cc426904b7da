"""Offer fields and score from a VARIANT column."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import fixed


def offer_field(offer: Column, path: str, kind: str = "double") -> Column:
    """One field of an offer; null when absent or of the wrong kind."""
    return F.try_variant_get(offer, path, kind)


def lowest_apr(offer: Column) -> Column:
    """``apr.min`` of an object, or the value itself when ``apr`` is a scalar."""
    return F.coalesce(offer_field(offer, "$.apr.min"), offer_field(offer, "$.apr"))


def score_parts(
    apr: Column, fee: Column, rewards: Column, bonus: Column
) -> Column:
    """Sum of the four parts, two decimals.

    ``greatest`` skips nulls, so a missing APR or fee needs its own branch:
    without it, the missing value would earn full points.
    """
    apr_points = F.greatest(
        F.lit(0.0),
        fixed.APR_POINTS - F.greatest(F.lit(0.0), apr - fixed.APR_FREE),
    )
    fee_points = F.greatest(F.lit(0.0), fixed.FEE_POINTS - fee / fixed.FEE_PER_POINT)
    total = (
        F.when(apr.isNull(), 0.0).otherwise(apr_points)
        + F.when(fee.isNull(), 0.0).otherwise(fee_points)
        + F.least(F.lit(fixed.REWARDS_POINTS), F.coalesce(rewards, F.lit(0.0)))
        + F.least(F.lit(fixed.BONUS_POINTS), F.coalesce(bonus, F.lit(0.0)))
    )
    return F.floor(total * 100 + 0.5).cast("double") / 100


def offer_score(offer: Column) -> Column:
    """Score of an offer held as VARIANT."""
    return score_parts(
        lowest_apr(offer),
        offer_field(offer, "$.annual_fee"),
        offer_field(offer, "$.rewards_score"),
        offer_field(offer, "$.bonus_score"),
    )


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once per row, however often it is used."""
    return F.transform(F.array(value), use)[0]


def payload_offers(payload: Column) -> Column:
    """Offers in a JSON payload: a bare list, or a list under ``cards``.

    An object without ``cards`` holds no offers. Text that is neither, or a list
    with anything but objects in it, gives null.
    """
    as_map = "map<string,variant>"

    def listed(doc: Column) -> Column:
        bare = F.try_variant_get(doc, "$", "array<variant>")
        wrapped = F.try_variant_get(doc, "$.cards", "array<variant>")
        is_object = F.try_variant_get(doc, "$", as_map).isNotNull()
        has_cards = F.try_variant_get(doc, "$.cards", "variant").isNotNull()
        none = F.array().cast("array<variant>")
        return F.coalesce(bare, wrapped, F.when(is_object & ~has_cards, none))

    def objects(found: Column) -> Column:
        whole = F.forall(found, lambda o: F.try_variant_get(o, "$", as_map).isNotNull())
        return F.when(whole, found)

    return bind(bind(F.try_parse_json(payload), listed), objects)


def ranked_offers(offers: Column) -> Column:
    """``array<struct<rank, pos, score, offer>>``, best first, ties in input order.

    The offers of one payload lie in one row, so they are ranked in that row.
    """

    def rank(given: Column) -> Column:
        scored = F.transform(
            given,
            lambda o, i: F.struct((-offer_score(o)).alias("down"), i.alias("pos")),
        )
        return F.transform(
            F.array_sort(scored),
            lambda s, i: F.struct(
                (i + 1).alias("rank"),
                s["pos"].alias("pos"),
                (F.lit(0.0) - s["down"]).alias("score"),
                F.get(given, s["pos"]).alias("offer"),
            ),
        )

    return bind(offers, rank)


def with_rank_fields(offer: Column, score: Column, rank: Column) -> Column:
    """The offer as JSON text with its ``score`` and ``rank`` set."""
    fields = F.try_variant_get(offer, "$", "map<string,variant>")
    others = F.map_filter(fields, lambda k, _: ~k.isin("score", "rank"))
    return F.to_json(
        F.map_concat(
            others,
            F.create_map(
                F.lit("score"),
                score.cast("variant"),
                F.lit("rank"),
                rank.cast("variant"),
            ),
        )
    )
