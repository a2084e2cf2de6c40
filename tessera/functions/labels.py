"""Lookups of labels: sides, rating scales, tiers, read states, quotas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Leans with a side, and leans that are a position but no side.
SIDES = {"left": "left", "lean_left": "left", "centre": "centre", "center": "centre", "lean_right": "right", "right": "right"}
SIDE_LABELS = {"left": "Left / progressive", "centre": "Centre", "right": "Right / conservative"}
OFF_AXIS = ("state", "varies", "pro_sovereignty")

# Rating scales, from -3 (strongly left) to 3 (strongly right).
SCALES = {
    "allsides": {"left": -2, "lean left": -1, "center": 0, "centre": 0, "lean right": 1, "right": 2},
    "mbfc": {"extreme left": -3, "left": -2, "left-center": -1, "least biased": 0, "right-center": 1, "right": 2, "extreme right": 3},
}
SCALE_LABELS = {-3: "strongly left", -2: "left", -1: "leans left", 0: "centre", 1: "leans right", 2: "right", 3: "strongly right"}
FLAGS = ("conspiracy-pseudoscience", "conspiracy", "questionable", "pro-science", "satire")


def lookup(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), key)


def side_of(lean: Column) -> Column:
    return lookup(SIDES, F.lower(lean))


def reason_for_no_side(lean: Column) -> Column:
    """Why a lean has no side; unrated is a statement on our records, not on the outlet."""
    low, shown = F.lower(F.coalesce(lean, F.lit(""))), F.coalesce(lean, F.lit("null"))
    return (
        F.when(low == "unrated", F.lit("no bias rating on file for this outlet yet"))
        .when(low.isin(*OFF_AXIS), F.concat(F.lit('lean "'), shown, F.lit('" is not a left-right position')))
        .otherwise(F.concat(F.lit('unmapped lean "'), shown, F.lit('"')))
    )


def half_up(c: Column) -> Column:
    """Round half towards positive infinity."""
    return F.floor(c + 0.5).cast("int")


def ad_fontes_scale(bias: Column) -> Column:
    return F.when(bias.isNotNull() & ~F.isnan(bias), F.greatest(F.lit(-3), F.least(F.lit(3), half_up(bias / 14))))


def normalise_rating(provider: Column, raw: Column) -> Column:
    key = F.lower(F.trim(raw))
    return (
        F.when(provider == "allsides", lookup(SCALES["allsides"], key))
        .when(provider == "mbfc", lookup(SCALES["mbfc"], key))
        .when(provider == "adfontes", ad_fontes_scale(raw.try_cast("double")))
    )


def scale_label(n: Column) -> Column:
    return F.coalesce(lookup(SCALE_LABELS, n), F.lit("unplaced"))


def read_state(article_ok: Column, excerpt: Column) -> Column:
    return F.when(F.coalesce(article_ok, F.lit(False)), "article read").when(F.coalesce(F.length(excerpt), F.lit(0)) > 0, "headline and feed excerpt").otherwise("headline only")


def tier(documents: Column, outlets: Column) -> Column:
    return F.when(documents > 0, "primary").when(outlets >= 2, "multi").otherwise("single")


def parse_quotas(spec: str) -> dict[str, int]:
    """'Canada=3,India=' -> {'Canada': 3, 'India': 0}; what is no number is left out. On the driver: a spec is one line."""
    out = {}
    for part in spec.split(","):
        name, _, n = part.partition("=")
        name, n = name.strip(), n.strip() or "0"
        if name and "=" in part and n.lstrip("-").isdigit():
            out[name] = int(n)
    return out
