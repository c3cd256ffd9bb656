"""Column functions: text, dates, numbers and identifiers as the warehouse takes them in."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Weight classes by the first text that a bout's type contains, in this order.
WEIGHT_CLASSES = [
    ("Women's Strawweight", "women_strawweight"), ("Women's Flyweight", "women_flyweight"), ("Women's Bantamweight", "women_bantamweight"), ("Women's Featherweight", "women_featherweight"),
    ("Light Heavyweight", "light_heavyweight"), ("Super Heavyweight", "super_heavyweight"), ("Heavyweight", "heavyweight"), ("Featherweight", "featherweight"), ("Lightweight", "lightweight"), ("Welterweight", "welterweight"),
    ("Middleweight", "middleweight"), ("Bantamweight", "bantamweight"), ("Flyweight", "flyweight"), ("Strawweight", "strawweight"), ("Open Weight", "open_weight"), ("Catch Weight", "catch_weight"),
]
#: Weight classes as pages name them; the last one that occurs counts.
PAGE_CLASSES = ["women's strawweight", "women's flyweight", "women's bantamweight", "women's featherweight", "flyweight", "bantamweight", "featherweight", "lightweight", "welterweight", "middleweight", "light heavyweight", "heavyweight", "catch weight", "open weight"]
#: Methods of finish by their trimmed, lower-case text.
FINISHES = {"decision": "decision", "ko/tko": "ko_tko", "submission": "submission", "tko - doctor's stoppage": "doctor_stoppage", "overturned": "overturned", "could not continue": "could_not_continue", "dq": "dq", "other": "other"}
#: Fixed value: the name space of URLs for name-based UUIDs.
URL_SPACE = "6ba7b8119dad11d180b400c04fd430c8"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c: Column | str) -> Column:
    """Trimmed; empty becomes null."""
    return F.nullif(F.trim(col(c)), F.lit(""))


def integer(c: Column | str, default: int | None = 0) -> Column:
    """An empty cell is the default; a text that is no number raises."""
    v = text(c).cast("int")
    return v if default is None else F.coalesce(v, F.lit(default))


def real(c: Column | str) -> Column:
    return text(c).cast("double")


def iso_date(c: Column | str) -> Column:
    return F.to_date(text(c), "yyyy-MM-dd")


def utc_timestamp(c: Column | str) -> Column:
    """'2026-03-18 10:20:30 UTC' or an ISO time."""
    t = F.regexp_replace(text(c), r"\s*UTC\z", "+00:00")
    return F.when(t.isNotNull(), t.cast("timestamp"))


def weight_class(c: Column | str) -> Column:
    """The first class whose text occurs; null if none does."""
    out = None
    for words, name in WEIGHT_CLASSES:
        hit = col(c).contains(words)
        out = F.when(hit, name) if out is None else out.when(hit, name)
    return out


def title_flags(c: Column | str) -> tuple[Column, Column]:
    """(is_title_fight, is_interim_title); a null type is neither."""
    return F.coalesce(col(c).contains("Title Bout"), F.lit(False)), F.coalesce(col(c).contains("Interim"), F.lit(False))


def finish(c: Column | str) -> Column:
    """The method's name; null for unknown texts."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in FINISHES.items() for x in kv]), F.lower(F.trim(col(c))))


def outcome(a: Column | str, b: Column | str, first: Column | str, second: Column | str) -> tuple[Column, Column]:
    """(result_type, winner) of a pair of outcome letters: W/L, L/W, D/D; any other pair is no contest."""
    pair = F.concat(F.coalesce(F.trim(col(a)), F.lit("")), F.lit("/"), F.coalesce(F.trim(col(b)), F.lit("")))
    result = F.when(pair.isin("W/L", "L/W"), "win").when(pair == "D/D", "draw").otherwise("nc")
    return result, F.when(pair == "W/L", col(first)).when(pair == "L/W", col(second))


def clock_seconds(minute: Column | str, second: Column | str, null_at_zero: bool = False) -> Column:
    s = integer(minute) * 60 + integer(second)
    return F.nullif(s, F.lit(0)) if null_at_zero else s


def fight_seconds(method: str, finish_round: str, finish_time: str, rounds: str) -> Column:
    """A decision lasts all rounds (null if their number is unknown); else up to the finish; else all rounds; else null."""
    full = F.col(rounds).cast("double") * 300
    ended = (F.col(finish_round) - 1).cast("double") * 300 + F.col(finish_time)
    return F.when(F.col(method) == "decision", full).otherwise(F.coalesce(ended, full))


def rate(a: Column, b: Column) -> Column:
    """a / b as a double, null where b is 0 or null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def share(a: Column, b: Column) -> Column:
    """a / (a + b), null where that sum is 0 or either is null."""
    return rate(a, a + b)


def clean(c: Column | str) -> Column:
    """Runs of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(col(c), r"[\t-\r\x1c-\x20\x85\p{Z}]+", " "))


def without_www(c: Column | str) -> Column:
    return F.regexp_replace(col(c), r"(://)www\.", "$1")


def uuid5(c: Column | str) -> Column:
    """The name-based UUID of a URL: SHA-1 of name space and name, with version and variant bits set."""
    h = F.sha1(F.concat(F.unhex(F.lit(URL_SPACE)), F.encode(col(c), "utf-8")))
    variant = F.substring(F.lit("89ab89ab89ab89ab"), F.conv(F.substring(h, 17, 1), 16, 10).cast("int") + 1, 1)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))


def landed_attempted(c: Column | str) -> tuple[Column, Column]:
    """'12 of 30' as two integers; (0, 0) for other texts."""
    part = lambda i: F.coalesce(F.nullif(F.regexp_extract(col(c), r"(\d+) of (\d+)", i), F.lit("")).cast("int"), F.lit(0))
    return part(1), part(2)


def long_date(c: Column | str) -> Column:
    """'March 18, 2026'; null for other texts."""
    return F.try_to_date(text(c), "MMMM d, yyyy")


def short_date(c: Column | str) -> Column:
    """'Mar 18, 2026'; null for '--' and other texts."""
    return F.try_to_date(text(c), "MMM d, yyyy")


def location(c: Column | str) -> tuple[Column, Column, Column]:
    """(city, state, country) of 'city, state, country' or 'city, country'; empty texts otherwise."""
    p = F.transform(F.split(col(c), ","), lambda x: F.trim(x))
    n, blank = F.size(p), F.lit("")
    return F.when(n.isin(2, 3), F.get(p, 0)).otherwise(blank), F.when(n == 3, F.get(p, 1)).otherwise(blank), F.when(n == 3, F.get(p, 2)).when(n == 2, F.get(p, 1)).otherwise(blank)


def height(c: Column | str) -> tuple[Column, Column, Column]:
    """(feet, inches, centimetres) of 6' 0\"; nulls for other texts."""
    part = lambda i: F.nullif(F.regexp_extract(col(c), r"(\d+)'\s*(\d+)", i), F.lit("")).cast("int")
    return part(1), part(2), (part(1) * 12 + part(2)) * F.lit(2.54)


def first_number(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(col(c), r"(\d+)", 1), F.lit("")).cast("int")


def reach_cm(c: Column | str) -> Column:
    """Inches as whole centimetres, cut off."""
    return F.floor(first_number(c) * F.lit(2.54)).cast("int")


def record(c: Column | str) -> tuple[Column, ...]:
    """(wins, losses, draws, no contests) of '27-9-0 (1 NC)'; zeros for other texts."""
    part = lambda p, i: F.coalesce(F.nullif(F.regexp_extract(col(c), p, i), F.lit("")).cast("int"), F.lit(0))
    return *[part(r"(\d+)-(\d+)-(\d+)", i) for i in (1, 2, 3)], part(r"\((\d+) NC\)", 1)


def split_name(c: Column | str) -> tuple[Column, Column]:
    """First word, and the rest joined by blanks."""
    p = F.split(clean(c), " ")
    return F.get(p, 0), F.array_join(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), " ")


def split_finish(c: Column | str) -> tuple[Column, Column]:
    """(primary, secondary) in lower case; only what has 'decision' in it is taken apart at ' - ' (null where nothing follows)."""
    t = F.lower(F.trim(col(c)))
    p, cut = F.split(t, " - "), t.contains("decision")
    return F.when(cut, F.get(p, 0)).otherwise(t), F.when(cut, F.get(p, 1))


def clock(c: Column | str) -> tuple[Column, Column]:
    """(minutes, seconds) of 'm:ss'; zeros for other texts."""
    ok = col(c).rlike(r"\A\d+:\d+\z")
    part = lambda i: F.when(ok, F.split_part(col(c), F.lit(":"), F.lit(i)).cast("int")).otherwise(0)
    return part(1), part(2)


def raw_weight_class(c: Column | str) -> Column:
    """As pages are read: the last name of the list that occurs in the lower-cased text (so 'light heavyweight' reads
    heavyweight, a women's class but strawweight its plain name, and a plain strawweight nothing)."""
    low = F.lower(col(c))
    return F.coalesce(*[F.when(low.contains(n), n) for n in reversed(PAGE_CLASSES)])


def entity_of_url(c: Column | str) -> Column:
    return F.when(col(c).contains("event-details"), "event").when(col(c).contains("fight-details"), "fight").when(col(c).contains("fighter-details"), "fighter").otherwise("unknown")


def joined(c: Column) -> Column:
    return F.array_join(c, ", ")


def parted(c: Column | str) -> Column:
    """The list in a cell of ', '-joined texts, without empty ones."""
    return F.filter(F.transform(F.split(col(c), ","), lambda x: F.trim(x)), lambda x: x != "")


def percent(a: Column, b: Column) -> Column:
    """'12.5%', or 'n/a' of nothing."""
    return F.when(b == 0, "n/a").otherwise(F.format_string("%.1f%%", F.bround(a * 100.0 / b, 1)))


def hrefs(c: Column | str, containing: str = "") -> Column:
    """Targets of the anchors in a page, those that contain a text."""
    found = F.regexp_extract_all(col(c), F.lit(r'(?i)<a\s[^>]*?href\s*=\s*"([^"]*)"'), F.lit(1))
    return F.filter(found, lambda x: x.contains(containing)) if containing else found
