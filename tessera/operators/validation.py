"""Rules that a finished record must meet, as one array of problems a record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIDES = ("left", "centre", "right")


def _blank(c: Column) -> Column:
    return F.trim(F.coalesce(c.cast("string"), F.lit(""))) == ""


def _p(cond: Column, code: str, path: Column | str, level: str = "error") -> Column:
    where = path if isinstance(path, Column) else F.lit(path)
    return F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(level).alias("level"), F.lit(code).alias("code"), where.alias("path")))


def _at(name: str, i: Column, rest: str = "") -> Column:
    return F.concat(F.lit(f"{name}["), i.cast("string"), F.lit(f"]{rest}"))


def problems(cards: DataFrame) -> DataFrame:
    """(card, level, code, path) for every rule that a card breaks.

    cards: card bigint, sources array<struct<n,t,u,b,label_source struct<provider,url>,kind>>, headline, context, coverage,
    regions array<string>, facts array<struct<t,s array<int>,tier>>, disputed array<struct<t>>, views
    array<struct<side,label,outlet,s array<int>,text,status>>, axis struct<applies,name>, gaps array<string>, _prose.
    """
    empty = lambda c, kind: F.coalesce(F.col(c), F.from_json(F.lit("[]"), kind))
    kinds = {f.name: f.dataType for f in cards.schema.fields}
    src, facts, views = (empty(c, kinds[c]) for c in ("sources", "facts", "views"))
    n = F.size(src)
    urls = F.transform(src, lambda s: s["u"])

    def source(s: Column, i: Column) -> Column:
        provider = s["label_source"]["provider"]
        return F.array(
            _p(F.coalesce(s["n"], F.lit("")) == "", "source-unnamed", _at("sources", i, ".n")),
            _p(F.coalesce(s["t"], F.lit("")) == "", "source-untitled", _at("sources", i, ".t")),
            _p(~F.coalesce(s["u"], F.lit("")).rlike("(?i)^https?://"), "source-url", _at("sources", i, ".u")),
            _p(F.array_contains(F.slice(urls, F.lit(1), i), s["u"]), "source-duplicate", _at("sources", i, ".u"), "warn"),
            _p((provider == "mbfc") & _blank(s["label_source"]["url"]), "mbfc-unlinked", _at("sources", i, ".labelSource.url")),
            _p(~_blank(s["b"]) & _blank(provider), "label-unattributed", _at("sources", i, ".labelSource"), "warn"),
        )

    valid = lambda c: (c >= 0) & (c < n)
    names = lambda cites: F.transform(F.filter(cites, valid), lambda c: F.get(src, c)["n"])
    none = F.array().cast("array<int>")

    def fact(f: Column, i: Column) -> Column:
        cites = F.coalesce(f["s"], none)
        outlets = F.size(F.array_distinct(names(cites)))
        bad = F.transform(F.filter(cites, lambda c: ~F.coalesce(valid(c), F.lit(False))), lambda c: _p(F.lit(True), "fact-bad-index", _at("facts", i, ".s")))
        primary = F.exists(F.filter(cites, valid), lambda c: F.coalesce(F.get(src, c)["kind"] == "primary", F.lit(False)))
        one = F.array(
            _p(_blank(f["t"]), "fact-empty", _at("facts", i, ".t")),
            _p(F.size(cites) == 0, "fact-uncited", _at("facts", i, ".s")),
            _p((f["tier"] == "multi") & (outlets < 2), "tier-multi-unsupported", _at("facts", i, ".tier")),
            _p((f["tier"] == "primary") & ~primary, "tier-primary-unsupported", _at("facts", i, ".tier")),
            _p((f["tier"] == "single") & (outlets > 1), "tier-single-understated", _at("facts", i, ".tier"), "warn"),
            _p(~F.coalesce(f["tier"].isin("multi", "primary", "single"), F.lit(False)), "tier-missing", _at("facts", i, ".tier")),
        )
        return F.concat(one, bad)

    sides = F.transform(views, lambda v: v["side"])

    def view(v: Column, i: Column) -> Column:
        known = F.coalesce(v["side"].isin(*SIDES), F.lit(False))
        text = ~_blank(v["text"])
        absent = F.coalesce(v["status"] == "not sourced", F.lit(False)) | ((F.coalesce(v["outlet"], F.lit("")) == "") & ~text)
        cites = F.coalesce(v["s"], none)
        live = known & ~absent
        cited = F.filter(names(cites), lambda o: F.coalesce(o, F.lit("")) != "")
        named = F.exists(cited, lambda o: F.lower(F.coalesce(v["outlet"], F.lit(""))).contains(F.lower(o)))
        bad = F.transform(F.filter(cites, lambda c: ~F.coalesce(valid(c), F.lit(False))), lambda c: _p(live, "view-bad-index", _at("views", i, ".s")))
        one = F.array(
            _p(~known, "view-side", _at("views", i, ".side")),
            _p(known & F.array_contains(F.slice(sides, F.lit(1), i), v["side"]), "view-duplicate", _at("views", i, ".side")),
            _p(known & absent & text, "view-synthesised", _at("views", i, ".text")),
            _p(live & ~text, "view-empty", _at("views", i, ".text")),
            _p(live & _blank(v["outlet"]), "view-unattributed", _at("views", i, ".outlet")),
            _p(live & (F.size(cites) == 0), "view-uncited", _at("views", i, ".s")),
            _p(live & (F.size(cited) > 0) & ~named, "view-outlet-mismatch", _at("views", i, ".outlet")),
        )
        return F.concat(one, bad)

    whole = F.array(
        _p(n == 0, "no-sources", "sources"),
        *(_p(_blank(F.col(c)), "prose-missing", c) for c in ("headline", "context", "coverage")),
        *(_p(F.col(c).isNull(), "prose-null", c) for c in ("headline", "context", "coverage")),
        _p(F.coalesce(F.size("regions"), F.lit(0)) <= 0, "no-regions", "regions"),
        _p(F.size(facts) == 0, "no-facts", "facts"),
        *(_p(~F.coalesce(F.array_contains(sides, s), F.lit(False)), "view-missing", "views") for s in SIDES),
        _p((F.col("axis.applies") == F.lit(False)) & _blank(F.col("axis.name")), "axis-unnamed", "axis.name"),
        _p(F.coalesce(F.col("_prose"), F.lit("")) != "", "candidate-leftover", "_prose", "warn"),
    )
    gaps = F.transform(empty("gaps", kinds["gaps"]), lambda g, i: _p(_blank(g), "gap-empty", _at("gaps", i)))
    disputed = F.transform(empty("disputed", kinds["disputed"]), lambda d, i: _p(_blank(d["t"]), "disputed-empty", _at("disputed", i, ".t")))
    every = F.concat(F.flatten(F.transform(src, source)), whole, F.flatten(F.transform(facts, fact)), F.flatten(F.transform(views, view)), gaps, disputed)
    return cards.select("card", F.inline(F.array_compact(every)))


def payload_problems(cards: DataFrame) -> DataFrame:
    """``problems`` and, over all cards, sides that no card has a sourced view of (card null)."""
    got = cards.select(F.explode("views").alias("v")).where((F.col("v.status") != "not sourced") & ~_blank(F.col("v.text"))).agg(*(F.count_if(F.col("v.side") == s).alias(s) for s in SIDES))
    some = cards.limit(1).agg(F.count(F.lit(1)).alias("n"))
    starved = got.join(F.broadcast(some)).select(F.inline(F.array_compact(F.array(*(_p((F.col(s) == 0) & (F.col("n") > 0), "balance-starved", F.lit(s)) for s in SIDES)))))
    return problems(cards).unionByName(starved.select(F.lit(None).cast("bigint").alias("card"), "level", "code", "path"))


def raw_shapes(cards: DataFrame, column: str = "json") -> DataFrame:
    """(card, level, code, path) for raw JSON cards whose gaps or disputed are no arrays, or that are no objects."""
    j = F.col(column)
    kind = lambda p: F.substring(F.trim(F.get_json_object(j, p)), 1, 1)
    rows = F.array(
        _p(F.substring(F.trim(j), 1, 1) != "{", "payload-shape", ""),
        _p(F.get_json_object(j, "$.gaps").isNotNull() & (kind("$.gaps") != "["), "gaps-shape", "gaps"),
        _p(F.get_json_object(j, "$.disputed").isNotNull() & (kind("$.disputed") != "["), "disputed-shape", "disputed"),
    )
    return cards.select("card", F.inline(F.array_compact(rows)))


#: What ``problems`` reads of a card, and the names of its fields in JSON where they differ.
PROSE = ("headline", "context", "coverage")


def parse_cards(raw: DataFrame, column: str = "json") -> DataFrame:
    """(card, the columns of ``problems``, shapes, absent) of cards as JSON text, read as variants with a type for each path.

    A part of another type than its place asks for counts as missing, an index that is no whole number as one that does not exist; numbers
    and flags in the place of text are text. shapes: the problems of shape; absent: prose that is not there at all, which is no
    null. Text that is no JSON, or no object, has the problem payload-shape and no other.
    """
    v = F.col("__v")
    get = lambda x, path, kind: F.try_variant_get(x, path, kind)
    text = lambda x, path: get(x, path, "string")
    kind_of = lambda x, path: F.schema_of_variant(get(x, path, "variant"))
    items = lambda x, path: F.coalesce(get(x, path, "array<variant>"), F.array().cast("array<variant>"))
    is_list = lambda path: F.coalesce(kind_of(v, path).startswith("ARRAY"), F.lit(False))
    there = lambda path: get(v, path, "variant").isNotNull()

    def index(x: Column) -> Column:
        number = F.coalesce(F.schema_of_variant(x).rlike("^(BIGINT|DECIMAL|DOUBLE)"), F.lit(False))
        n = F.when(number, get(x, "$", "double"))
        return F.when((n == F.floor(n)) & (n >= 0) & (n < 2**31), n.cast("int")).otherwise(-1)

    cites = lambda x: F.transform(items(x, "$.s"), index)
    source = lambda x: F.struct(text(x, "$.n").alias("n"), text(x, "$.t").alias("t"), text(x, "$.u").alias("u"), text(x, "$.b").alias("b"), F.struct(text(x, "$.labelSource.provider").alias("provider"), text(x, "$.labelSource.url").alias("url")).alias("label_source"), text(x, "$.kind").alias("kind"))
    fact = lambda x: F.struct(text(x, "$.t").alias("t"), cites(x).alias("s"), text(x, "$.tier").alias("tier"))
    view = lambda x: F.struct(*(text(x, f"$.{c}").alias(c) for c in ("side", "label", "outlet")), cites(x).alias("s"), text(x, "$.text").alias("text"), text(x, "$.status").alias("status"))
    applies = F.when(F.coalesce(kind_of(v, "$.axis.applies") == "BOOLEAN", F.lit(False)), get(v, "$.axis.applies", "boolean"))
    whole = F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))
    shapes = F.array(_p(~whole, "payload-shape", ""), _p(whole & there("$.gaps") & ~is_list("$.gaps"), "gaps-shape", "gaps"), _p(whole & there("$.disputed") & ~F.is_variant_null(get(v, "$.disputed", "variant")) & ~is_list("$.disputed"), "disputed-shape", "disputed"))
    absent = F.array_compact(F.array(*(F.when(~there(f"$.{c}"), F.lit(c)) for c in PROSE)))
    return raw.withColumn("__v", F.try_parse_json(F.col(column))).select(
        "card", F.transform(items(v, "$.sources"), source).alias("sources"), *(text(v, f"$.{c}").alias(c) for c in PROSE), F.transform(items(v, "$.regions"), lambda x: text(x, "$")).alias("regions"),
        F.transform(items(v, "$.facts"), fact).alias("facts"), F.transform(items(v, "$.disputed"), lambda x: F.struct(text(x, "$.t").alias("t"))).alias("disputed"), F.transform(items(v, "$.views"), view).alias("views"),
        F.struct(applies.alias("applies"), text(v, "$.axis.name").alias("name")).alias("axis"), F.transform(items(v, "$.gaps"), lambda x: text(x, "$")).alias("gaps"), text(v, "$._prose").alias("_prose"),
        F.array_compact(shapes).alias("shapes"), absent.alias("absent"), whole.alias("whole"),
    )


def raw_problems(raw: DataFrame, column: str = "json") -> DataFrame:
    """(card, level, code, path): all rules, over cards as JSON text. Cards of the right shape have the problems that ``problems`` finds."""
    cards = parse_cards(raw, column)
    lacking = cards.select("card", F.explode("absent").alias("path"), F.lit("prose-null").alias("code")).distinct()
    found = problems(cards.where("whole").drop("shapes", "absent", "whole")).join(lacking, ["card", "path", "code"], "left_anti")
    return found.select("card", "level", "code", "path").unionByName(cards.select("card", F.inline("shapes")))


def summarise(found: DataFrame) -> DataFrame:
    """One row: ok, errors, warnings. Callers that gate on it stop where ok is false."""
    return found.agg(F.count_if(F.col("level") == "error").alias("errors"), F.count_if(F.col("level") == "warn").alias("warnings")).select((F.col("errors") == 0).alias("ok"), "errors", "warnings")
