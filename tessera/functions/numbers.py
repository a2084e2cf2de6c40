"""Numbers in text, with what they count. The unit has no word boundary, as in the rules that this matches: '25 members' is 25 million."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.text import collapse_edges, let, trim_to_words

# What a unit multiplies by.
SCALE = {"thousand": 1e3, "k": 1e3, "million": 1e6, "m": 1e6, "billion": 1e9, "bn": 1e9, "b": 1e9, "trillion": 1e12, "tn": 1e12}
# Word boundaries are those of ASCII, so they are written out. How a number with its currency and unit is written.
NUMBER = r"(?i)([$€£₹]|(?<!\w)US\$|(?<!\w)C\$)?\s?(\d[\d,]*(?:\.\d+)?)\s*(percent|per cent|%|thousand|million|billion|trillion|bn|tn|k|m|b)?"
FIGURE = r"(?i)([$€£₹]|(?<!\w)US\$|(?<!\w)C\$)?\s?(\d[\d,]*(?:\.\d+)?)\s*(percent|per cent|%|thousand|million|billion|trillion|bn|tn)?"
BEFORE = r"(?i)(?:between|from)\s*\z|[-–—]\s*\z|(?<!\w)to\s*\z"
AFTER = r"(?i)^\s*(?:[-–—]|to(?!\w)|and(?!\w))\s*[$€£₹]?\s*\d"


def _matches(c: Column, pattern: str) -> Column:
    """array<struct(m, at)>: each match and where it starts (from 0)."""
    # the gap after the last match has no match
    pairs = F.filter(F.zip_with(F.split(c, pattern, -1), F.regexp_extract_all(c, F.lit(pattern), F.lit(0)), lambda g, m: F.struct(g.alias("g"), m.alias("m"))), lambda p: p["m"].isNotNull())
    none = F.array().cast("array<struct<m:string,at:int>>")
    step = lambda a, p: F.struct((a["at"] + F.length(p["g"]) + F.length(p["m"])).alias("at"), F.concat(a["out"], F.array(F.struct(p["m"].alias("m"), (a["at"] + F.length(p["g"])).cast("int").alias("at")))).alias("out"))
    return F.aggregate(pairs, F.struct(F.lit(0).alias("at"), none.alias("out")), step, lambda a: a["out"])


def quantities(text: Column) -> Column:
    """array<struct(raw, value, kind, currency, subject, in_range)>; bare numbers under 1000 are left out."""
    return let(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "), _quantities)


def _quantities(joined: Column) -> Column:
    scale = F.create_map(*(F.lit(v) for kv in SCALE.items() for v in kv))

    def part(x: Column) -> Column:
        m, at = x["m"], x["at"]
        unit = F.lower(F.regexp_extract(m, NUMBER, 3))
        start = F.greatest(F.lit(0), at - 60)
        return F.struct(
            F.trim(m).alias("raw"), F.regexp_extract(m, NUMBER, 1).alias("currency"), F.when(unit.isin("per cent", "%"), F.lit("percent")).otherwise(unit).alias("unit"),
            F.regexp_replace(F.regexp_extract(m, NUMBER, 2), ",", "").cast("double").alias("number"),
            F.substring(joined, start + 1, at - start).alias("before"), F.substring(joined, at + F.length(m) + 1, F.lit(60)).alias("after"),
        )

    def whole(q: Column) -> Column:
        words = F.regexp_extract_all(F.lower(F.concat(q["after"], F.lit(" "), q["before"])), F.lit("[a-z]{4,}"), F.lit(0))
        kind = F.when(q["unit"] == "percent", F.lit("percent")).when(q["currency"] != "", F.lit("currency")).otherwise(F.lit("count"))
        return F.struct(
            q["raw"].alias("raw"), (q["number"] * F.coalesce(F.try_element_at(scale, q["unit"]), F.lit(1.0))).alias("value"), kind.alias("kind"), F.nullif(q["currency"], F.lit("")).alias("currency"),
            F.array_distinct(F.slice(words, 1, 6)).alias("subject"), (q["before"].rlike(BEFORE) | q["after"].rlike(AFTER)).alias("in_range"),
        )

    kept = F.filter(F.transform(_matches(joined, NUMBER), part), lambda q: (q["currency"] != "") | (q["unit"] != "") | (q["number"] >= 1000))
    return F.transform(kept, whole)


def figures(text: Column, most: int = 6) -> Column:
    """array<struct(value, context)>: the first numbers with a currency or unit, in fifty characters either side, cut to twenty words."""

    def found(t: Column) -> Column:
        real = F.filter(_matches(t, FIGURE), lambda x: (F.regexp_extract(x["m"], FIGURE, 1) != "") | (F.regexp_extract(x["m"], FIGURE, 3) != ""))

        def one(x: Column) -> Column:
            start = F.greatest(F.lit(0), x["at"] - 50)
            return F.struct(F.trim(x["m"]).alias("value"), trim_to_words(collapse_edges(F.substring(t, start + 1, x["at"] + F.length(x["m"]) + 50 - start)), 20).alias("context"))

        return F.transform(F.slice(real, 1, most), one)

    return let(text, found)
