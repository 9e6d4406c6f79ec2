"""Scalar expressions of the feature tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The ladders of rounds, lowest first, and categories by level mark.
MAIN_LADDER = ("Q1", "Q2", "Q3", "BR", "RR", "R128", "R64", "R32", "R16", "QF", "SF", "F", "3P")
FULL_LADDER = ("Q1", "Q2", "Q3", "BR", "RR", "ER", "R128", "R64", "R32", "R16", "QF", "SF", "F", "3P")
LEVELS = {"G": "gs", "M": "1000", "A": "atp500"}


def mapped(key: Column, values: Mapping) -> Column:
    """Value of a key in a fixed map; null for others."""
    items = iter(values.items())
    k, v = next(items)
    out = F.when(key == k, v)
    for k, v in items:
        out = out.when(key == k, v)
    return out


def recoded(key: Column, values: Mapping) -> Column:
    """Value of a key in a fixed map; the key itself for others."""
    return F.coalesce(mapped(key, values), key)


#: Names of courts, rounds and roofs as pages have them, and what they are called here.
COURTS = {"Outdoor Hard": "Hard", "Indoor Hard": "Hard", "Outdoor Clay": "Clay", "Indoor Clay": "Clay", "Outdoor Grass": "Grass", "Indoor Carpet": "Carpet"}
ROUNDS = {"Final": "F", "Finals": "F", "Semi-Finals": "SF", "Semifinals": "SF", "Quarter-Finals": "QF", "Quarterfinals": "QF", "Round of 16": "R16", "Round of 32": "R32", "Round of 64": "R64", "Round of 128": "R128", "Round Robin": "RR", "3rd Place Match": "3P", "1st Round Qualifying": "Q1", "2nd Round Qualifying": "Q2", "3rd Round Qualifying": "Q3"}
ROOFS = {"I": "Indoor", "O": "Outdoor"}


def place(label: Column, ladder: Sequence[str]) -> Column:
    """Place of a round on a ladder, from 1; null for an unknown one."""
    return mapped(label, {x: i + 1 for i, x in enumerate(ladder)})


def aligned(label: Column) -> Column:
    """Rounds of the full ladder on the main one."""
    return F.when(label == "ER", "R128").otherwise(label)


def leading_year(tournament_id: Column) -> Column:
    return F.regexp_extract(tournament_id, r"^(\d+)", 1).cast("int")


def code_of(tournament_id: Column) -> Column:
    """The tournament's own code behind the year."""
    return F.nullif(F.regexp_extract(tournament_id, r"^\d+-(.*)$", 1), F.lit(""))


def ordinal_start(day: Column, place: Column) -> Column:
    """Day and place of the round as an hour, sortable text."""
    return F.concat(day.cast("string"), F.lit(" "), F.lpad(place.cast("string"), 2, "0"))


def home(citizenship: Column, country: Column) -> Column:
    return F.coalesce((citizenship == country).cast("int"), F.lit(0))


def retired(mark: Column) -> Column:
    return F.coalesce((mark == "(RET)").cast("int"), F.lit(0))


def walkover(mark: Column) -> Column:
    return F.coalesce(mark.isin("(W/O)", "W/O", "(WEA)").cast("int"), F.lit(0))


def court(surface: Column) -> Column:
    """One of four courts named in a text; null if none is."""
    low = F.lower(surface)
    return F.when(low.contains("clay"), "Clay").when(low.contains("grass"), "Grass").when(low.contains("carpet"), "Carpet").when(low.contains("hard"), "Hard")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Null unless the denominator is positive."""
    return F.when(denominator > 0, numerator / denominator)


def clamped_games(won: Column, converted: Column, played: Column) -> Column:
    """Games won on serve: all won less breaks, between 0 and those served; null if any is."""
    known = won.isNotNull() & converted.isNotNull() & played.isNotNull()
    return F.when(known, F.greatest(F.lit(0), F.least(won - converted, played)))


def log_ratio(a: Column, b: Column, eps: float = 1e-6) -> Column:
    return F.when(a.isNotNull() & b.isNotNull(), F.log(F.greatest(a, F.lit(eps)) / F.greatest(b, F.lit(eps))))


def log_distance(a: Column, b: Column) -> Column:
    """Difference of logs; null unless both are positive."""
    return F.when((a > 0) & (b > 0), F.log(a) - F.log(b))


def trend(now: Column, then: Column, share: float) -> Column:
    """subida, bajada or estable, by the change against a share of the worse rank; null if a rank is."""
    known = now.isNotNull() & then.isNotNull()
    threshold = F.greatest(F.lit(1), F.ceil(F.greatest(now, then) * share))
    change = then - now
    return F.when(known, F.when(change >= threshold, "subida").when(change <= -threshold, "bajada").otherwise("estable"))


def trend_number(label: Column) -> Column:
    return mapped(label, {"subida": 1, "estable": 0, "bajada": -1})


def cut_sign(x: Column, at: float = 0.2) -> Column:
    """negative up to -at, neutral up to at, else positive."""
    return F.when(x <= -at, "negative").when(x <= at, "neutral").when(x.isNotNull(), "positive")


def smoothed(wins: Column, n: Column, weight: float) -> Column:
    """Share of wins drawn to a half by a prior of that weight, within 0.001 and 0.999."""
    return F.least(F.lit(0.999), F.greatest(F.lit(0.001), (F.coalesce(wins, F.lit(0)) + weight / 2) / (F.coalesce(n, F.lit(0)) + weight)))


def credibility(n: Column, weight: float) -> Column:
    return F.coalesce(n / (n + weight), F.lit(0.0))


def rest_flags(days: Column) -> dict[str, Column]:
    flag = lambda c: F.coalesce(c.cast("int"), F.lit(0))
    return {"back_to_back": flag(days <= 9), "two_weeks": flag((days > 9) & (days <= 16)), "long_rest": flag(days >= 21)}


def fatigue(continent: Column, country: Column, surface: Column, indoor: Column) -> Column:
    """Weight of what changed since the last tournament."""
    return 2.0 * continent + 1.0 * country + 1.0 * surface + 0.5 * indoor


def changed(now: Column, then: Column) -> Column:
    return F.coalesce((now != then).cast("int"), F.lit(0))


def split_draw(text: Column) -> Column:
    """singles, doubles of '32/16'; null without a slash."""
    side = lambda i: F.nullif(F.trim(F.split_part(text, F.lit("/"), F.lit(i))), F.lit(""))
    return F.when(text.contains("/"), F.struct(side(1).alias("singles"), side(2).alias("doubles")))


def prize(text: Column) -> Column:
    """money (digits), currency (A$ or the first character) of '€2,345,000'; null for an empty text."""
    s = F.trim(text)
    two = s.startswith("A$")
    money = F.regexp_replace(F.when(two, F.substr(s, F.lit(3))).otherwise(F.substr(s, F.lit(2))), "[,.]", "")
    return F.when(F.length(s) > 0, F.struct(F.nullif(money, F.lit("")).alias("money"), F.when(two, "A$").otherwise(F.left(s, F.lit(1))).alias("currency")))


def location(text: Column) -> Column:
    """city (the first part, empty if there is one only), country (the last part) of 'City, Country'."""
    parts = F.transform(F.split(F.coalesce(text, F.lit("")), ","), lambda x: F.trim(x))
    return F.struct(F.when(F.size(parts) > 1, parts[0]).otherwise("").alias("city"), F.element_at(parts, -1).alias("country"))


#: Marks in a banner's address, in the order they are looked for, and their series.
BANNERS = {"categorystamps_500": "atp500", "categorystamps_finals": "atpFinal", "categorystamps_atpcup": "atpCup", "categorystamps_lvr": "laverCup", "categorystamps_nextgen": "nextGen", "categorystamps_1000": "1000"}
#: Fixed value: prize money from which a challenger is of the higher series.
CHALLENGER_MONEY = 75000


def series_of(key: Column, banner: Column, money: Column) -> Column:
    """The series of a tournament: by banner on the tour, by prize money for challengers, else the key itself."""
    tour = F.lit(None).cast("string")
    for mark, series in reversed(BANNERS.items()):
        tour = F.when(banner.contains(mark), series).otherwise(tour)
    rich = F.coalesce(money.try_cast("bigint") >= CHALLENGER_MONEY, F.lit(False))
    return F.when(key == "atp", F.coalesce(tour, F.lit("atp250"))).when(key == "ch", F.when(rich, "ch100").otherwise("ch50")).otherwise(key)


def finite(x: Column) -> Column:
    """Null for what is no finite number."""
    return F.when(~F.isnan(x) & (F.abs(x) != float("inf")), x)


#: Country codes and their continents.
CONTINENTS = """
AUS Oceania, QAT Asia, NZL Oceania, GER Europe, USA North America, IND Asia, FRA Europe, URU South America, UAE Asia, RUS Europe
NED Europe, VIE Asia, GBR Europe, DEN Europe, SGP Asia, JPN Asia, ECU South America, MAR Africa, ITA Europe, POR Europe
CHN Asia, ESP Europe, BER North America, MON Europe, CZE Europe, SLO Europe, ISR Asia, AUT Europe, BUL Europe, CRO Europe
SUI Europe, SWE Europe, CAN North America, BEL Europe, ARG South America, FIN Europe, TUR Europe, BRA South America, POL Europe, SMR Europe
UKR Europe, ROU Europe, HUN Europe, MKD Europe, UZB Asia, EGY Africa, PER South America, CHI South America, AND Europe, MEX North America
VEN South America, COL South America, SVK Europe, KOR Asia, CRC North America, THA Asia, SRB Europe, TUN Africa, BIH Europe, BOL South America
LUX Europe, IRI Asia, IRL Europe, PAR South America, RSA Africa, KAZ Asia, TPE Asia, MAS Asia, GRE Europe, CAL Oceania
GUD North America, PAN North America, HKG Asia, DOM North America, PHI Asia, BRN Asia, LTU Europe, PUR North America, KSA Asia, RWA Africa
GEO Europe, COD Africa, CIV Africa, MDA Europe
"""


def continents() -> dict[str, str]:
    """Continent by country code."""
    return dict(x.strip().split(" ", 1) for line in CONTINENTS.strip().splitlines() for x in line.split(","))


def continent(country: Column) -> Column:
    """The continent of a country's code; null for codes that the list lacks."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in continents().items() for x in pair]), country)
