"""Sinks: JSON with all fields, Markdown reports, exit gates."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def write_json(df: DataFrame, path: str, dry_run: bool = False) -> bool:
    """Overwrite a JSON folder, null fields included; nothing is written on a dry run."""
    if not dry_run:
        df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return not dry_run


def lines(spark: SparkSession, title: str, head: list[DataFrame], sections: dict[str, DataFrame], tables: dict[str, str] | None = None) -> DataFrame:
    """(part, kind, line): a Markdown report, to be sorted by its columns. head and sections: frames with a column ``line``; a section's
    lines come in their own order, an empty one says so. tables: what stands above the lines of a section that is a table."""
    fixed = [(0, 0, f"# {title}"), (0, 1, ""), (0, 9, "")]
    for i, name in enumerate(sections, 1):
        fixed += [(i, 0, f"## {name}"), (i, 1, ""), (i, 9, ""), *((i, 2, t) for n, t in (tables or {}).items() if n == name)]
    out = spark.createDataFrame(fixed, "part int, kind int, line string")
    for n, df in enumerate(head):
        out = out.unionByName(df.select(F.lit(0).alias("part"), F.lit(2 + n).alias("kind"), "line"))
    for i, df in enumerate(sections.values(), 1):
        none = df.agg(F.count(F.lit(1)).alias("n")).where("n = 0").select(F.lit("None.").alias("line"))
        out = out.unionByName(df.select("line").unionByName(none).select(F.lit(i).alias("part"), F.lit(3).alias("kind"), "line"))
    return out


def write_lines(report: DataFrame, path: str) -> None:
    """A report as one text file in a folder; the sort before it is distributed, the file is written by one task that streams."""
    report.orderBy("part", "kind", "line").coalesce(1).select("line").write.mode("overwrite").text(path)


def table_rows(df: DataFrame) -> DataFrame:
    """The rows of a frame as lines of a Markdown table; bars in values are escaped, nulls are empty."""
    cell = lambda c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|"))
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *(cell(c) for c in df.columns)), F.lit(" |")).alias("line"))


def table_head(df: DataFrame) -> str:
    return "| " + " | ".join(df.columns) + " |\n|" + "-|" * len(df.columns)


def splice(page: Column, name: str, payload: Column) -> Column:
    """``page`` with the array literal of ``const name = [...]`` replaced; brackets in strings do not count. Null where there is no such
    array or it does not end, so that callers can stop."""
    mark = f"const {name} = "
    rest = F.substring(page, F.instr(page, mark + "[") + len(mark), F.length(page))
    tokens = F.regexp_extract_all(rest, F.lit(r"""(?s)\\.|["'`]|[\[\]]|[^\\"'`\[\]]+|\\"""), F.lit(0))
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("quote"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("end"))

    def step(a: Column, t: Column) -> Column:
        free = a["quote"] == ""
        depth = a["depth"] + F.when(free & (t == "["), 1).when(free & (t == "]"), -1).otherwise(0)
        quote = F.when(free & t.isin('"', "'", "`"), t).when(t == a["quote"], "").otherwise(a["quote"])
        at = a["at"] + F.length(t)
        return F.when(a["end"].isNotNull(), a).otherwise(F.struct(depth.alias("depth"), quote.alias("quote"), at.alias("at"), F.when(depth == 0, at).alias("end")))

    end = F.aggregate(tokens, start, step)["end"]
    at = F.instr(page, mark + "[")
    return F.when(at > 0, F.concat(F.substring(page, F.lit(1), at + len(mark) - 1), payload, F.substring(rest, end + 1, F.length(page))))


def gate(starved: DataFrame, empty_sides: DataFrame, empty_leans: DataFrame, summary: DataFrame) -> DataFrame:
    """One row: what is wrong and the exit code that a caller should give (1 if anything is)."""
    one = lambda d, n: d.agg(F.count(F.lit(1)).alias(n))
    row = one(starved, "starved").join(F.broadcast(one(empty_sides, "empty_sides"))).join(F.broadcast(one(empty_leans, "empty_leans"))).join(F.broadcast(summary.select("errors")))
    bad = (F.col("starved") > 0) | (F.col("empty_sides") > 0) | (F.col("empty_leans") > 0) | (F.col("errors") > 0)
    return row.select("starved", "empty_sides", "empty_leans", "errors", F.when(bad, 1).otherwise(0).alias("exit_code"))


def run_report(counts: dict[str, DataFrame], balance: DataFrame, fill: DataFrame, failures: DataFrame) -> DataFrame:
    """One row: counts by name, balance by side, fill by region, and all failures by layer and reason (counted)."""
    # one pass over all inputs, each task counting first
    every = reduce(DataFrame.unionAll, (df.select(F.lit(name).alias("name")) for name, df in counts.items()))
    each = every.groupBy("name").agg(F.count(F.lit(1)).alias("n")).agg(*(F.coalesce(F.sum(F.when(F.col("name") == c, F.col("n"))), F.lit(0)).alias(c) for c in counts))
    row = each.select(F.struct("*").alias("counts"))
    b = balance.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("side", "candidates")))).alias("balance"))
    f = fill.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("region", F.struct("quota", "filled", "available"))))).alias("region_fill"))
    x = failures.groupBy("layer", "reason").agg(F.count(F.lit(1)).alias("n")).agg(F.array_sort(F.collect_list(F.struct("layer", "reason", "n"))).alias("failures"))
    return row.join(F.broadcast(b)).join(F.broadcast(f)).join(F.broadcast(x))
