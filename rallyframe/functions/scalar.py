"""Row-level expressions: clocks, text rules, ratios and court zones. All are Column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event codes and the sets the two foul rules use.
ON_COURT_EVENTS = (1, 2, 3, 4, 5, 6, 10)
TECHNICAL_LINEUP = (11, 16, 17, 18, 19, 25, 30)
TECHNICAL_COUNT = (11, 12, 13, 16, 17, 18, 19, 25)
TEAM_ID_FLOOR = 1_610_000_000
# Zone names in index order, radii in tenths of a foot, and eras.
ZONE_NAMES = (
    "Restricted Area",
    "Close Mid - Right", "Close Mid - Center", "Close Mid - Left",
    "Mid - Right", "Mid - Right Center", "Mid - Center", "Mid - Left Center", "Mid - Left",
    "3PT - Right", "3PT - Right Center", "3PT - Center", "3PT - Left Center", "3PT - Left",
)
RIM_RADIUS, CLOSE_RADIUS, HEAVE_RADIUS = 40.0, 110.0, 400.0
ERAS = ((1997, 197.5, 197.5, "19'9\""), (2004, 205.2, 205.2, "20'6.25\""), (2013, 221.5, 220.0, "22'1.75\""))
SCOPE_SUFFIX = {"reg": "", "playoffs": "-playoffs", "all": "-all"}


def clock_seconds(clock: Column) -> Column:
    """Seconds of ``M:SS``; null on anything else."""
    parts = F.split(clock, ":")
    whole = F.when(F.size(parts) == 2, F.get(parts, F.lit(0)).try_cast("int") * 60 + F.get(parts, F.lit(1)).try_cast("int"))
    return whole.cast("double")


def minutes_seconds(value: Column) -> Column:
    """Seconds of ``MM:SS`` (minutes may have decimals) or bare minutes; blank and null give 0."""
    text = F.trim(value)
    split = F.split(text, ":")
    both = F.get(split, F.lit(0)).try_cast("double") * 60 + F.get(split, F.lit(1)).try_cast("double")
    return F.when(F.coalesce(text, F.lit("")) == "", F.lit(0.0)).when(text.contains(":"), both).otherwise(text.try_cast("double") * 60)


def period_offset(period: Column, regular: Column, n_regular: Column, overtime: int = 300) -> Column:
    """Seconds before a period begins."""
    extra = F.greatest(period - 1 - n_regular, F.lit(0))
    return (F.least(period - 1, n_regular) * regular + extra * overtime).cast("double")


def elapsed(period: Column, remaining: Column, regular: Column, n_regular: Column, overtime: int = 300) -> Column:
    """Seconds since the start, from the time remaining in a period."""
    length = F.when(period <= n_regular, regular).otherwise(F.lit(overtime))
    return period_offset(period, regular, n_regular, overtime) + length - remaining


def safe_ratio(num: Column, den: Column) -> Column:
    """num / den where den is positive and finite, else null."""
    of = den.cast("double")
    return F.when((of > 0) & ~F.isnan(of) & (of < float("inf")), num.cast("double") / of)


def slugify(text: Column) -> Column:
    """Lower case, runs of other characters than a-z and 0-9 as one dash, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(text), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def padded_id(value: Column, width: int = 10) -> Column:
    """Ids that were read as numbers, with their zeros again."""
    return F.lpad(value.cast("string"), width, "0")


def joined_description(*parts: Column) -> Column:
    """Non-null descriptions joined by a space."""
    return F.concat_ws(" ", *parts)


def stint_description(home: Column, visitor: Column, neutral: Column) -> Column:
    """Descriptions as stints read them: home, visitor, neutral, in upper case."""
    return F.upper(joined_description(home, visitor, neutral))


def box_description(home: Column, neutral: Column, visitor: Column) -> Column:
    """Descriptions as box scores read them: home, neutral, visitor, in their own case."""
    return joined_description(home, neutral, visitor)


def known_number(value: Column, default: Column | None = None) -> Column:
    """A number that is neither null nor NaN, else the default, else null."""
    fine = F.when(~F.isnan(value), value)
    return fine if default is None else F.coalesce(fine, F.when(~F.isnan(default), default))


def whole_number(value: Column) -> Column:
    """A number or its text as an integer, half to even; null if it is none."""
    return F.bround(known_number(value.try_cast("double")), 0).try_cast("long")


def rounded(value: Column, places: int) -> Column:
    """A number to some places, half to even; null for null, NaN and what is no number."""
    return F.bround(known_number(value.try_cast("double")), places)


def scope_file(stem: str, scope: Column) -> Column:
    """``stem`` with the scope's suffix, as a JSON file's name; an unknown scope gives null."""
    suffix = F.lit(None).cast("string")
    for name, text in SCOPE_SUFFIX.items():
        suffix = F.when(scope == name, text).otherwise(suffix)
    return F.concat(F.lit(stem), suffix, F.lit(".json"))


def drawn_geometry(arc: Column, corner: Column) -> tuple[Column, Column]:
    """Radii to draw with: an arc that isn't a positive number is today's, such a corner is the arc's."""
    fine = lambda c: F.when((c > 0) & ~F.isnan(c), c)
    arc = F.coalesce(fine(arc), F.lit(ERAS[-1][1]))
    return arc, F.coalesce(fine(corner), arc)


def is_technical(code: Column, description: Column) -> Column:
    """Technical foul by code or by its text."""
    text = F.upper(F.coalesce(description, F.lit("")))
    return F.coalesce(code.isin(*TECHNICAL_LINEUP), F.lit(False)) | text.contains("T.FOUL") | text.contains("TECHNICAL")


def event_team(team_id: Column, player_id: Column) -> Column:
    """The event's team: its team column, else a player column that holds a team id."""
    return F.coalesce(F.when(team_id > 0, team_id), F.when(player_id >= TEAM_ID_FLOOR, player_id))


def free_throw_made_by_score(description: Column, score: Column) -> Column:
    """Made flag for stints: text says MISS, else text says points, else the row has a score."""
    d = F.upper(F.coalesce(description, F.lit("")))
    scored = F.trim(F.coalesce(score, F.lit(""))) != ""
    return F.when(d.contains("MISS"), 0).when(d.contains("PTS)"), 1).otherwise(scored.cast("int"))


def free_throw_made_by_text(description: Column) -> Column:
    """Made flag for box scores: the text doesn't begin with MISS."""
    return (~F.ltrim(F.coalesce(description, F.lit(""))).startswith("MISS")).cast("int")


def shot_points(description: Column) -> Column:
    return F.when(F.coalesce(description, F.lit("")).contains("3PT"), 3).otherwise(2)


def rebound_counts(description: Column) -> Column:
    """struct<off, def> of ``(Off:n Def:m)``; nulls if absent."""
    pattern = r"\(Off:(\d+)\s+Def:(\d+)\)"
    return F.struct(
        F.regexp_extract(description, pattern, 1).try_cast("int").alias("off"), F.regexp_extract(description, pattern, 2).try_cast("int").alias("def")
    )


def is_last_of_trip(description: Column) -> Column:
    """Whether ``n of m`` in the text has n = m; true without it."""
    n, m = (F.regexp_extract(F.coalesce(description, F.lit("")), r"(\d+) of (\d+)", i).try_cast("int") for i in (1, 2))
    return F.coalesce(n == m, F.lit(True))


def score_total(score: Column) -> Column:
    """Sum of both sides of ``H-A``; null if either isn't a number."""
    parts = F.split(score, "-")
    return F.when(F.size(parts) == 2, F.trim(F.get(parts, F.lit(0))).try_cast("int") + F.trim(F.get(parts, F.lit(1))).try_cast("int"))


def possessions(fga: Column, oreb: Column, tov: Column, fta: Column) -> Column:
    return F.greatest(fga - oreb + tov + F.lit(0.44) * fta, F.lit(0.0))


def era_value(season: Column, position: int) -> Column:
    """A field of the last era that began by ``season``; the first era before all."""
    out = F.lit(ERAS[0][position])
    for era in ERAS[1:]:
        out = F.when(season >= era[0], F.lit(era[position])).otherwise(out)
    return out


def zone_index(x: Column, y: Column, arc: Column, corner: Column) -> Column:
    """Index into ZONE_NAMES of a shot at (x, y); -1 for a heave, null without coordinates."""
    r = F.sqrt(x * x + y * y)
    raw = F.degrees(F.atan2(y, x))
    turn = F.when(raw < -90, raw + 360).otherwise(raw)
    meet = F.when(corner < arc, F.sqrt(F.greatest(arc * arc - corner * corner, F.lit(0.0)))).otherwise(F.lit(0.0))
    beyond = (r >= arc) | ((corner < arc) & (F.abs(x) >= corner) & (y <= meet))

    def wedge(n: int) -> Column:
        return F.least(F.greatest(F.floor(turn / (180 / n)), F.lit(0)), F.lit(n - 1))

    return (
        F.when(x.isNull() | y.isNull(), F.lit(None))
        .when(r >= HEAVE_RADIUS, -1)
        .when(r < RIM_RADIUS, 0)
        .when(beyond, 9 + wedge(5))
        .when(r < CLOSE_RADIUS, 1 + wedge(3))
        .otherwise(4 + wedge(5))
        .cast("int")
    )


def zone_name(index: Column) -> Column:
    return F.when(index == -1, "Heave").otherwise(F.coalesce(F.get(F.array(*map(F.lit, ZONE_NAMES)), index), F.lit("Unknown")))
