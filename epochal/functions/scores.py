"""Scores of matches as text: status, composition, and parsing, as column expressions.

A score is set tokens with the winner's games first: "64 36 76(5)", "2218", "108", "[10-8]".
Digits of a token split by its length: two are one game figure each; of three, a leading 1 with 8 or
9 more games behind tells which side reached ten; four are two figures each. Tie-breaks in brackets
are taken off first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Marks of a match that was not played, of one awarded, and of one broken off, in the order they are looked for.
NOT_PLAYED, AWARDED, BROKEN_OFF = ("W/O", "INV", "WALKOVER"), ("WEA",), ("RE", "RET", "DEF", "UNP", "UNFINISHED")


def status(score: Column) -> Column:
    """(W/O), (WEA), (RET) or null."""
    text = F.upper(score)

    def any_of(marks):
        out = F.lit(False)
        for m in marks:
            out = out | text.contains(m)
        return out

    return F.when(any_of(NOT_PLAYED), "(W/O)").when(any_of(AWARDED), "(WEA)").when(any_of(BROKEN_OFF), "(RET)")


def tokens(score: Column) -> Column:
    """Set tokens, tie-breaks and words taken off; [11-9] becomes the games of a deciding tie-break."""
    plain = F.regexp_replace(score, r"\([^)]*\)", "")
    decided = F.regexp_replace(plain, r"\[(\d+)-(\d+)\]", "T$1-$2")
    return F.filter(F.split(F.trim(decided), r"\s+"), lambda t: t.rlike(r"^(T\d+-\d+|\d{2,4})$"))


def games(token: Column) -> Column:
    """Games of both sides in a set token."""
    part = lambda a, n: F.substring(token, a, n).cast("int")
    n = F.length(token)
    first = F.when(token.startswith("T"), F.regexp_extract(token, r"^T(\d+)-", 1).cast("int")).when(n == 2, part(1, 1)).when((n == 3) & token.startswith("1"), part(1, 2)).when(n == 3, part(1, 1)).when(n == 4, part(1, 2))
    second = F.when(token.startswith("T"), F.regexp_extract(token, r"-(\d+)$", 1).cast("int")).when(n == 2, part(2, 1)).when((n == 3) & token.startswith("1"), part(3, 1)).when(n == 3, part(2, 2)).when(n == 4, part(3, 2))
    return F.struct(first.alias("won"), second.alias("lost"), token.startswith("T").alias("tie"))


#: Fixed value: the code of the tournament whose sets go to four games.
SHORT_SETS = "7696"


def parsed(score: Column, code: Column | None = None) -> Column:
    """sets, games and tie-breaks of winner and loser; null where the match has a status.

    code: the tournament's; where sets go to four games, 4-3 was decided by a tie-break.
    """
    short = F.lit(False) if code is None else F.coalesce(code == SHORT_SETS, F.lit(False))
    sets = F.transform(tokens(score), games)
    zero = F.struct(*[F.lit(0).alias(c) for c in ("sets_won", "sets_lost", "games_won", "games_lost", "ties_won", "ties_lost")])

    def add(acc, s):
        mine = (s["won"] > s["lost"]).cast("int")
        high, low = F.greatest(s["won"], s["lost"]), F.least(s["won"], s["lost"])
        close = s["tie"] | ((high == 7) & (low == 6)) | (short & (high == 4) & (low == 3))
        counted = F.when(s["tie"], 0).otherwise(1)
        return F.struct(
            (acc["sets_won"] + mine).alias("sets_won"),
            (acc["sets_lost"] + 1 - mine).alias("sets_lost"),
            (acc["games_won"] + s["won"] * counted + F.when(s["tie"], mine).otherwise(0)).alias("games_won"),
            (acc["games_lost"] + s["lost"] * counted + F.when(s["tie"], 1 - mine).otherwise(0)).alias("games_lost"),
            (acc["ties_won"] + F.when(close, mine).otherwise(0)).alias("ties_won"),
            (acc["ties_lost"] + F.when(close, 1 - mine).otherwise(0)).alias("ties_lost"),
        )

    return F.when(status(score).isNull() & score.isNotNull(), F.aggregate(sets, zero, add))


def composed(won: Column, lost: Column, ties: Column) -> Column:
    """Score text from arrays of games and of the loser's tie-break points (null without one)."""
    pairs = F.zip_with(F.zip_with(won, lost, lambda a, b: F.concat(a.cast("string"), b.cast("string"))), ties, lambda s, t: F.when(t.isNotNull(), F.concat(s, F.lit("("), t.cast("string"), F.lit(")"))).otherwise(s))
    return F.array_join(pairs, " ")


def n_sets(score: Column) -> Column:
    """Sets in a match; 0 if it was not played to its end or has no score."""
    return F.when(status(score).isNotNull() | score.isNull() | F.upper(score).contains("ABN"), 0).otherwise(F.size(tokens(score)))


def best_of(sets_won: Column, category: Column) -> Column:
    """5 for the top category or three sets won, else 3."""
    return F.when((category == "gs") | (sets_won >= 3), 5).otherwise(3)
