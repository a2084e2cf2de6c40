"""Chat formatting by quotation linking, in DataFrame functions only.

Lines that open with > marks are quotes; the number of marks is their level. Runs of lines of one level are passages;
normalised (lower case, letters and digits only, single blanks) they are hashed and joined to the message of the same
conversation in which the passage was first written: as its whole body, a paragraph or a line of it. A passage that was never
written as a whole before (a trimmed quote, or one of several messages) is looked for paragraph by paragraph, and a paragraph
that was not line by line; each piece is at most as late as the message it was taken from, so the latest origin of a passage's
pieces stands for it. The match of the lowest level is what a message replies to; the earliest message wins, so each hash has one row
and a phrase that everybody quotes joins once per quote. Replies follow what they answer: a thread's messages are numbered as a
walk from its first message meets them, the replies to one message by turn. Threads, depths and numbers are found by pointer
doubling over replies only: the numbers by ranking the list of steps into and out of each message.

Scale: messages without quotes go through one pass; only hashes are joined, one row per (conversation, hash) on one side and one
for each passage and each of its paragraphs and lines on the other. Pointer doubling takes two short rows a reply and a round for each
doubling of the longest thread, so a chain of any length costs no more a reply than its logarithm. The final order is by ranges
of (conversation, thread, place), so a conversation of any size spreads over tasks, and none is collected.

Defined cases: null text is empty, null roles become 'user', null conversations form one of their own, a null turn sorts first
and neither quotes nor is quoted; repeated rows repeat; messages of one (conversation, turn) share their replies; other
columns are ignored; without any quote every message is its own thread, in turn order.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Saved

_LINES = r"transform(split(text, '\\r?\\n'), l -> named_struct('level', length(regexp_replace(regexp_extract(l, '^[ \\t>]*>', 0), '[^>]', '')), 'words', trim(regexp_replace(l, '^[ \\t>]*>', ''))))"
#: Runs of one level: a fold that appends to the last run or starts another.
_RUNS = """
aggregate(lines,
  named_struct('runs', cast(array() AS array<struct<level:int,words:string>>), 'level', 0, 'words', ''),
  (a, l) -> CASE WHEN l.level = a.level THEN named_struct('runs', a.runs, 'level', a.level, 'words', concat(a.words, '\\n', l.words))
    ELSE named_struct('runs', CASE WHEN a.level > 0 THEN concat(a.runs, array(named_struct('level', a.level, 'words', a.words))) ELSE a.runs END, 'level', l.level, 'words', l.words) END,
  a -> CASE WHEN a.level > 0 THEN concat(a.runs, array(named_struct('level', a.level, 'words', a.words))) ELSE a.runs END)"""
#: What is looked for of each passage: all of it (part -1), its paragraphs and their lines, where they are not all of it.
_PIECES = r"""
flatten(transform(quotes, (q, i) -> concat(
  array(named_struct('run', i, 'part', -1, 'kind', 0, 'level', q.level, 'words', q.words)),
  flatten(transform(split(q.words, '\\n\\s*\\n'), (p, j) -> concat(
    filter(array(named_struct('run', i, 'part', j, 'kind', 1, 'level', q.level, 'words', p)), x -> x.words <> q.words),
    transform(filter(array_distinct(split(p, '\\n')), l -> l <> p), l -> named_struct('run', i, 'part', j, 'kind', 2, 'level', q.level, 'words', l))))))))"""
#: The body: lines of level 0, without a line of attribution right before a quote.
_BODY = r"""
trim(regexp_replace(array_join(transform(filter(transform(lines, (l, i) -> named_struct('l', l, 'next', coalesce(get(lines, i + 1).level, 0))),
  x -> x.l.level = 0 AND NOT (x.next > 0 AND x.l.words rlike '(wrote|writes|said):$')), x -> x.l.words), '\n'), '\\n{3,}', '\n\n'))"""


def normalised(words: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(words), r"[^\p{L}\p{N}]+", " "))


def _key(words: Column) -> Column:
    return F.unhex(F.sha2(F.encode(normalised(words), "UTF-8"), 256))


def parse(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, body, quotes array<struct<level, words>>) for every message."""
    rows = messages.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", F.lit("user")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    # texts without a mark at the start of a line need no parsing
    quoting = F.col("text").rlike(r"(?m)^[ \t]*>")
    rows = rows.withColumn("lines", F.when(quoting, F.expr(_LINES)))
    body = F.when(quoting, F.expr(_BODY)).otherwise(F.trim("text"))
    return rows.select("conv_id", "turn", "role", body.alias("body"), F.when(quoting, F.expr(_RUNS)).alias("quotes"))


def replies(parsed: DataFrame) -> DataFrame:
    """(conv_id, turn, parent): what a message replies to, one row per replying (conversation, turn)."""
    quotes = parsed.where("quotes IS NOT NULL AND turn IS NOT NULL").select("conv_id", "turn", F.xxhash64("quotes").alias("m"), F.explode(F.expr(_PIECES)).alias("q"))
    quotes = quotes.select("conv_id", "turn", "m", "q.run", "q.part", "q.kind", "q.level", _key(F.col("q.words")).alias("key"), normalised(F.col("q.words")).alias("n")).where("n <> ''").drop("n")
    bodies = parsed.where("turn IS NOT NULL AND body <> ''").join(quotes.select("conv_id").distinct().withColumnRenamed("conv_id", "__c"), F.col("conv_id").eqNullSafe(F.col("__c")), "left_semi")
    pieces = F.array_distinct(F.concat(F.array("body"), F.split("body", r"\n\s*\n"), F.split("body", r"\n")))
    origin = bodies.select("conv_id", "turn", F.explode(pieces).alias("piece")).where(normalised(F.col("piece")) != "")
    origin = origin.select(F.col("conv_id").alias("oc"), F.col("turn").alias("parent"), _key(F.col("piece")).alias("okey")).groupBy("oc", "okey").agg(F.min("parent").alias("parent"))
    met = quotes.join(origin, F.col("conv_id").eqNullSafe(F.col("oc")) & (F.col("key") == F.col("okey"))).where("parent < turn")
    late = (-F.col("parent")).alias("late")
    # lines count where their paragraph has no origin, paragraphs where the passage has none; of several the latest origin
    met = met.groupBy("conv_id", "turn", "m", "level", "run", "part").agg(F.min_by("parent", F.struct("kind", late)).alias("parent"))
    met = met.groupBy("conv_id", "turn", "m", "level", "run").agg(F.min_by("parent", F.struct(F.col("part") >= 0, late)).alias("parent"))
    # the lowest level is the direct one; of several passages the latest origin
    return met.groupBy("conv_id", "turn").agg(F.min_by("parent", F.struct("level", late)).alias("parent"))


def _doubled(state: Saved, step, tag: str) -> Saved:
    """``step`` applied to a written table of (conv_id, ..., moved) until no row moves."""
    while True:
        new = Saved(step(state.df), tag)
        state.drop()
        state = new
        if not state.df.where("moved").limit(1).count():
            return state


def threads(links: DataFrame) -> Saved:
    """(conv_id, turn, parent, thread, depth, place) for every message that replies or that is first in a thread with replies."""
    def same(*on: Column) -> Column:
        return functools.reduce(Column.__and__, on, F.col("conv_id").eqNullSafe(F.col("c")))

    def climb(at: DataFrame) -> DataFrame:
        above = at.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("up").alias("further"), F.col("depth").alias("more"))
        met = at.join(above, same(F.col("up") == F.col("t")), "left")
        return met.select("conv_id", "turn", "parent", F.coalesce("further", "up").alias("up"), (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"), F.col("t").isNotNull().alias("moved"))

    def walk(at: DataFrame) -> DataFrame:
        after = at.select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), F.col("out").alias("o"), F.col("next_turn").alias("nt"), F.col("next_out").alias("no"), F.col("left").alias("l"))
        met = at.join(after, same(F.col("next_turn") == F.col("t"), F.col("next_out") == F.col("o")), "left")
        return met.select("conv_id", "turn", "out", F.col("nt").alias("next_turn"), F.col("no").alias("next_out"), (F.col("left") + F.coalesce("l", F.lit(0))).alias("left"), F.col("nt").isNotNull().alias("moved"))

    tops = _doubled(Saved(links.select("conv_id", "turn", "parent", F.col("parent").alias("up"), F.lit(1).alias("depth")), "tops"), climb, "tops")
    replies_ = tops.df.select("conv_id", "turn", "parent", F.col("up").alias("thread"), "depth")
    firsts = replies_.select("conv_id", "thread").distinct().select("conv_id", F.col("thread").alias("turn"), F.lit(None).cast("bigint").alias("parent"), "thread", F.lit(0).alias("depth"))
    nodes = Saved(replies_.unionByName(firsts), "nodes")
    child = nodes.df.where("parent IS NOT NULL").groupBy(F.col("conv_id").alias("c"), F.col("parent").alias("p")).agg(F.min("turn").alias("child"))
    # the step into a message leads to its first reply or out of it; the step out of it to the next reply of the same message or out of that
    into = nodes.df.join(child, same(F.col("turn") == F.col("p")), "left").select("conv_id", "turn", F.lit(0).alias("out"), F.coalesce("child", "turn").alias("next_turn"), F.when(F.col("child").isNull(), 1).otherwise(0).alias("next_out"), F.lit(1).alias("left"))
    later = F.when(F.col("parent").isNotNull(), F.lead("turn").over(Window.partitionBy("conv_id", "parent").orderBy("turn")))
    out = nodes.df.withColumn("later", later).select("conv_id", "turn", F.lit(1).alias("out"), F.coalesce("later", "parent").alias("next_turn"), F.when(F.col("later").isNull(), 1).otherwise(0).alias("next_out"), F.lit(0).alias("left"))
    steps = _doubled(Saved(into.unionByName(out), "steps"), walk, "steps")
    # what is left of the walk from the step into a message on, itself included
    left = steps.df.where("out = 0").select(F.col("conv_id").alias("c"), F.col("turn").alias("t"), "left")
    own = nodes.df.join(left, same(F.col("turn") == F.col("t"))).drop("c", "t")
    whole = left.select("c", F.col("t"), F.col("left").alias("all"))
    done = Saved(own.join(whole, same(F.col("thread") == F.col("t"))).select("conv_id", "turn", "parent", "thread", "depth", (F.col("all") - F.col("left")).alias("place")), "threads")
    for s in (tops, nodes, steps):
        s.drop()
    return done


def conversations(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, role, parent_turn, thread, depth, place, body, formatted), in reply order within conversations."""
    parsed = parse(messages)
    links = Saved(replies(parsed), "replies")
    none = F.lit(0)
    if links.df.limit(1).count():
        found = threads(links.df).df.select(F.col("conv_id").alias("__c"), F.col("turn").alias("__t"), F.col("parent").alias("parent_turn"), F.col("thread").alias("__thread"), F.col("depth").alias("__depth"), F.col("place").alias("__place"))
        rows = parsed.join(found, F.col("conv_id").eqNullSafe(F.col("__c")) & (F.col("turn") == F.col("__t")), "left")
        rows = rows.select("conv_id", "turn", "role", "body", "parent_turn", F.coalesce("__thread", "turn").alias("thread"), F.coalesce("__depth", none).alias("depth"), F.coalesce("__place", none).alias("place"))
    else:
        rows = parsed.select("conv_id", "turn", "role", "body", F.lit(None).cast("bigint").alias("parent_turn"), F.col("turn").alias("thread"), none.alias("depth"), none.alias("place"))
    links.drop()
    formatted = F.concat(F.lit("<|"), F.col("role"), F.lit("|>\n"), F.col("body"), F.lit("\n<|end|>\n"))
    out = rows.select("conv_id", "turn", "role", "parent_turn", "thread", "depth", "place", "body", formatted.alias("formatted"))
    return out.orderBy("conv_id", "thread", "place", "role", "body")
