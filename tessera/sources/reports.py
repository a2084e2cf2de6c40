"""The four Markdown reports: feed validation, feed diagnosis, rating review, applied feed results, each as a frame of lines (part, kind,
line) that ``sinks.write_lines`` writes; nothing of them passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import labels as L
from tessera.operators import feeds, matching
from tessera.sources.sinks import lines

# The headings and wording of the reports below, and the roster's leans that a rating's letters stand for.
RATED_LEAN = {"left": "left", "leftcenter": "lean_left", "center": "centre", "leastbiased": "centre", "rightcenter": "lean_right", "right": "right", "proscience": "centre"}


def _text(*parts: Column | str) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("-")) for p in parts))


def _if(c: Column, *parts: Column | str) -> Column:
    return F.when(c.isNotNull(), _text(*parts)).otherwise("")


def _said(df: DataFrame, text: str) -> DataFrame:
    """One line of a fixed text; ``df`` only says where."""
    return df.sparkSession.createDataFrame([(text,)], "line string")


def _verified(checks: DataFrame) -> DataFrame:
    return checks.agg(_text("Verified: ", F.count_if("ok"), "/", F.count(F.lit(1))).alias("line"))


def _by_lean(checks: DataFrame) -> DataFrame:
    return matching.lean_balance(checks).select(_text("- ", F.col("lean"), ": ", F.col("ok"), "/", F.col("total"), " verified").alias("line"))


def _bold(name: str = "name") -> Column:
    return _text("- **", F.col(name), "**")


def feed_report(checks: DataFrame, run: str) -> DataFrame:
    """checks: name, lean, country, url, ok, note, redirected, suggested."""
    failed = checks.where("NOT ok").select(F.concat(_bold(), _text(" (", F.coalesce("lean", "country"), ") — ", F.col("note")), _if(F.col("suggested"), " — try `", F.col("suggested"), "`"), _text("\n  - tried: `", F.coalesce("url", F.lit("(none)")), "`")).alias("line"))
    moved = checks.where("ok AND redirected IS NOT NULL").select(F.concat(_bold(), _text(": `", F.col("url"), "` -> `", F.col("redirected"), "`")).alias("line"))
    return lines(checks.sparkSession, "Feed validation report", [_said(checks, f"Run: {run}"), _verified(checks)], {"Balance by lean": _by_lean(checks), "Failures": failed, "Redirects worth pinning": moved})


def diagnosis_report(probes: DataFrame, run: str) -> DataFrame:
    """probes: id, agent, ok, note."""
    cell = lambda a: F.coalesce(F.max(F.when(F.col("agent") == a, F.when(F.col("ok"), _text("OK (", F.col("note"), ")")).otherwise(F.col("note")))), F.lit("-"))
    rows = probes.groupBy("id").agg(*(cell(a).alias(a) for a in ("current", "compatible", "browser"))).join(feeds.diagnose(probes), "id")
    found = rows.select(_text("| ", F.col("id"), " | ", F.col("current"), " | ", F.col("compatible"), " | ", F.col("browser"), " | ", F.col("verdict"), " |").alias("line"))
    return lines(probes.sparkSession, "Feed diagnosis", [_said(probes, f"Run: {run}")], {"Results": found}, {"Results": "| Outlet | current | compatible | browser | verdict |\n|-|-|-|-|-|"})


def disagreements(rated: DataFrame) -> DataFrame:
    """(id, name, lean, bias) where a rating's bias stands for another lean than the roster's. rated: id, name, lean, bias."""
    stands = L.lookup(RATED_LEAN, F.regexp_replace(F.lower(F.coalesce("bias", F.lit(""))), "[^a-z]", ""))
    return rated.where(stands.isNotNull() & ~stands.eqNullSafe(F.col("lean"))).select("id", "name", "lean", "bias")


def rating_review(ladder: DataFrame, roster: DataFrame, ratings: DataFrame) -> DataFrame:
    """ladder: id, status, matched_on, rating_name; roster: id, name, country, lean; ratings: name, bias, factual, mbfc_url (one row a name)."""
    r = ratings.select(F.col("name").alias("rating_name"), "bias", "factual", "mbfc_url").dropDuplicates(["rating_name"])
    j = ladder.join(roster.select("id", "name", "country", "lean"), "id").join(r, "rating_name", "left")
    review = j.where("status = 'review'").select(F.concat(_bold(), _text(" (", F.col("lean"), ") — matched by ", F.col("matched_on"), ": ", F.col("rating_name"), ", bias ", F.col("bias"), ", factual ", F.col("factual"), ", link ", F.coalesce("mbfc_url", F.lit("none: cannot be shown")))).alias("line"))
    missed = j.where("status = 'missed'").select(F.concat(_bold(), _text(" (", F.col("country"), ", ", F.col("lean"), ")")).alias("line"))
    applied = j.where("status = 'applied'")
    done = applied.select(F.concat(_bold(), _text(" — ", F.col("bias"), " / factual ", F.col("factual"), " (roster lean: ", F.col("lean"), ")")).alias("line"))
    against = disagreements(applied).select(F.concat(_bold(), _text(" — roster `", F.col("lean"), "` vs rating `", F.col("bias"), "`")).alias("line"))
    n = lambda status: F.count_if(F.col("status") == status)
    head = [ladder.agg(_text("Applied: ", n("applied"), "/", F.count(F.lit(1))).alias("line")), ladder.agg(_text("To be confirmed: ", n("review")).alias("line")), ladder.agg(_text("No match: ", n("missed")).alias("line"))]
    return lines(ladder.sparkSession, "Rating review", head, {"Needs confirmation": review, "No record found": missed, "Applied": done, "Roster lean and rating disagree": against})


def applied_report(results: DataFrame, roster: DataFrame, merged: DataFrame, run: str) -> DataFrame:
    """results: id, name, lean, country, url, ok, note; the roster before and after (id, name, feed)."""
    before = roster.select("id", F.col("feed").alias("was"))
    changed = merged.join(before, "id").where("NOT feed <=> was").select(F.concat(_bold(), _text("\n  - was: `", F.col("was"), "`\n  - now: `", F.col("feed"), "`")).alias("line"))
    failing = results.where("NOT ok").select(F.concat(_bold(), _text(" (", F.coalesce("lean", "country"), ") — ", F.col("note"), "\n  - tried: `", F.col("url"), "`")).alias("line"))
    unknown = matching.strangers(results, roster).select(_text("- ", F.col("id"), " (", F.col("name"), ")").alias("line"))
    return lines(results.sparkSession, "Feed validation report", [_said(results, f"Run: {run}"), _verified(results)], {"Balance by lean": _by_lean(results), "URL changes applied": changed, "Still failing": failing, "In results but not in the roster": unknown})
