"""Column functions on text: entities, markup, titles, tokens, sentences. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that carry no topic.
STOPWORDS = """
a an and are as at be been but by for from has have he her his how i in is it its
of on or our over said say says she that the their them they this to was were what
when where which who will with would you your not no new after before more most
says up down out about against during under while than then there here been being
us u.s its it's amid ahead top live update updates video watch photos opinion
""".split()

# The named entities that are decoded.
ENTITIES = {
    "nbsp": " ", "amp": "&", "quot": '"', "apos": "'", "lt": "<", "gt": ">",
    "rsquo": "’", "lsquo": "‘", "ldquo": "“", "rdquo": "”",
    "mdash": "—", "ndash": "–", "hellip": "…",
    "eacute": "é", "egrave": "è", "agrave": "à", "ccedil": "ç",
    "uuml": "ü", "ouml": "ö", "auml": "ä", "szlig": "ß",
    "laquo": "«", "raquo": "»", "deg": "°", "pound": "£", "euro": "€",
}

# Titles of recurring formats.
BOILERPLATE = (
    r"(?i)^headlines for |^daily cartoon|^(the )?week in pictures|^(morning|evening|weekend) (briefing|update|digest)|^news in brief"
    r"|^(photos|pictures) of the (day|week)|^watch:? |^live:? "
    r"|^\d{1,2} (january|february|march|april|may|june|july|august|september|october|november|december) \d{4}\z"
)
# Marks of digests in titles and urls.
DIGEST_TITLE = r"(?i)\.\s+(and|also|plus),|[.!?]\s+\S.*[.!?]\s+\S"
DIGEST_URL = "(?i)(up-first|newsletter|morning-brief|daily-brief|week-in-review|roundup|digest|live-updates|liveblog)"


def let(c: Column, f) -> Column:
    """f(c) with c computed once, however often f uses it: expressions inside lambdas share nothing by themselves."""
    return F.get(F.transform(F.array(c), f), 0)


def _numeric(pattern: str, base: int):
    """Every numeric reference as its character; code points that do not exist vanish."""

    def char(m: Column) -> Column:
        digits = F.regexp_replace(F.lower(F.regexp_extract(m, pattern, 1)), "^0+", "")
        number = F.when(F.length(digits) > (6 if base == 16 else 7), F.lit(-1)).otherwise(F.coalesce(F.conv(digits, base, 10).cast("bigint"), F.lit(-1)))
        good = lambda v: (v > 0) & (v <= 1114111) & ~v.between(55296, 57343)
        return let(number, lambda v: F.when(good(v), F.decode(F.unhex(F.lpad(F.hex(v), 8, "0")), "UTF-32")).otherwise(F.lit("")))

    return lambda x: F.when(x.rlike(pattern), _rebuilt(x, pattern, char)).otherwise(x)


def _rebuilt(x: Column, pattern: str, char) -> Column:
    found = F.transform(F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), char)
    return F.array_join(F.zip_with(F.split(x, pattern, -1), found, lambda t, v: F.concat(t, F.coalesce(v, F.lit("")))), "")


def _named(x: Column) -> Column:
    names = F.create_map(*(F.lit(v) for kv in ENTITIES.items() for v in kv))
    char = lambda m: F.coalesce(F.try_element_at(names, F.lower(F.substring(m, F.lit(2), F.length(m) - 2))), m)
    return F.when(x.rlike("&[a-zA-Z]+;"), _rebuilt(x, "&[a-zA-Z]+;", char)).otherwise(x)


def decode_entities_once(c: Column) -> Column:
    """Hexadecimal, decimal and named references, in this order; unknown names stay. Null is empty."""
    c = F.coalesce(c.cast("string"), F.lit(""))
    return let(let(let(c, _numeric("(?i)&#x([0-9a-f]+);", 16)), _numeric(r"&#(\d+);", 10)), _named)


def decode_entities(c: Column) -> Column:
    """Twice, since feeds are often encoded twice."""
    return decode_entities_once(decode_entities_once(c))


def collapse(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"(?U)\s+", " "), r"^ | \z", "")


def strip_html(c: Column) -> Column:
    c = F.coalesce(c, F.lit(""))
    c = F.regexp_replace(F.regexp_replace(c, r"(?is)<script.*?</script>", " "), r"(?is)<style.*?</style>", " ")
    return collapse(F.regexp_replace(decode_entities(F.regexp_replace(c, "<[^>]+>", " ")), "<[^>]+>", " "))


def normalise_title(c: Column) -> Column:
    """Without one trailing outlet name behind a dash, bar or dot."""
    return collapse_edges(F.regexp_replace(F.coalesce(c, F.lit("")), r"(?U)\s+[-–—|·]\s+[^-–—|·]{2,40}\z", ""))


def collapse_edges(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def tokenise(c: Column) -> Column:
    """Lower-case terms of three characters or more, or digits, without stopwords; repeats stay."""
    plain = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[‘’“”]", "'"), "[^a-z0-9$%.' -]", " ")
    words = F.transform(F.split(plain, r"[\s'-]+"), lambda t: F.regexp_replace(t, r"^[.$%]+|[.$%]+\z", ""))
    # isin with many literals is a hash lookup
    return F.filter(words, lambda t: ((F.length(t) >= 3) | t.rlike(r"^\d+\z")) & ~t.isin(sorted(set(STOPWORDS))))


def is_boilerplate(title: Column) -> Column:
    return normalise_title(title).rlike(BOILERPLATE)


def is_digest(title: Column, url: Column) -> Column:
    return normalise_title(title).rlike(DIGEST_TITLE) | F.coalesce(url, F.lit("")).rlike(DIGEST_URL)


def excerpt(c: Column, limit: int = 400) -> Column:
    """Cut to ``limit`` characters at the last end of a sentence in the second half, else at the limit."""

    def cut(x: Column) -> Column:
        head = F.substring(x, 1, limit)
        last = F.length(F.regexp_extract(head, r"(?s)^(.*[.?!]) ", 1))
        short = F.when(last > limit * 0.5 + 1, F.substring(head, F.lit(1), last)).otherwise(F.regexp_replace(head, r"(?U)\s+\z", ""))
        return F.when(F.length(x) <= limit, x).otherwise(F.concat(short, F.lit(" …")))

    return let(c, cut)


def trim_to_words(c: Column, most) -> Column:
    """The first ``most`` words (a number or a column) and an ellipsis, which is a word of its own; short texts stay."""
    most = most if isinstance(most, Column) else F.lit(most)

    def cut(words: Column) -> Column:
        return F.when(F.size(words) > most, F.concat(F.regexp_replace(F.array_join(F.slice(words, F.lit(1), most), " "), r"[,;:]\z", ""), F.lit(" …")))

    return F.coalesce(let(F.split(c, r"\s+"), cut), c)


def normalise_name(c: Column) -> Column:
    c = F.regexp_replace(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), r"\(.*?\)", " "), r"(?<!\w)(the|news|online|daily|post|times|com)(?!\w)", " ")
    return F.regexp_replace(c, "[^a-z0-9]+", "")


# Elements without prose here, elements that end a line and openings of lines that are no prose in paragraphs.
_BLOCKS = r"(?is)<(script|style|nav|footer|aside|form|noscript|figure|header)[^>]*>.*?</\1>"


def paragraphs(html: Column) -> Column:
    """Lines of prose: twelve words or more, ended like a sentence, no call to share or subscribe."""
    body = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), _BLOCKS, " "), r"(?s)<!--.*?-->", " ")
    body = F.regexp_replace(body, r"(?i)</?(p|div|section|article|main|h[1-6]|li|br|blockquote)[^>]*>", "\n")
    lines = F.transform(F.split(F.regexp_replace(body, "<[^>]+>", " "), "\n"), lambda x: collapse(F.when(x.contains("&"), decode_entities(x)).otherwise(x)))
    bad = r"(?i)^(share|subscribe|sign up|read more|advertisement|cookie)"
    return F.filter(lines, lambda x: (F.size(F.split(x, r"\s+")) >= 12) & x.rlike("[.!?\"'”]\\z") & ~x.rlike(bad))


def sentences(lines: Column) -> Column:
    """Sentences of six words or more, in order."""
    cut = F.flatten(F.transform(lines, lambda p: F.split(p, r"(?<=[.!?][”\"']?)\s+(?=[A-Z\"“])")))
    return F.filter(F.transform(cut, collapse_edges), lambda s: F.size(F.split(s, r"\s+")) >= 6)


def fnv1a(c: Column) -> Column:
    """FNV-1a over characters, 32 bits, in base 36."""
    step = lambda h, ch: F.pmod(h.bitwiseXOR(F.ascii(ch).cast("bigint")) * F.lit(16777619).cast("bigint"), F.lit(4294967296).cast("bigint"))
    return F.lower(F.conv(F.aggregate(F.filter(F.split(c, ""), lambda x: x != ""), F.lit(2166136261).cast("bigint"), step).cast("string"), 10, 36))
