"""Names of the runnable queries, each with the SQL that DuckDB runs for the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from epochal.sources import tables

_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_ORACLES: dict[str, str] = {}

#: Named parts that an oracle may use.
PARTS = {
    "m": tables.MATCHES,
    "st": tables.STATS,
    "sd": tables.SIDES,
    "rk": tables.RANKINGS,
    "pl": tables.PLAYERS,
    "t": tables.TOURNAMENTS,
    "p": """select id, start_dtm, tournament_id, rnd, surface, match_ret, winner as player_code, loser as opponent_code, 'win' as match_result from m
      union all select id, start_dtm, tournament_id, rnd, surface, match_ret, loser, winner, 'loss' from m""",
    "q": "select p.*, " + ", ".join(f"case when match_result = 'win' then {a}_{c} else {b}_{c} end as {n}{c}" for n, a, b in (("", "w", "l"), ("opponent_", "l", "w")) for c in tables.COUNTS) + " from p left join sd on sd.id = p.id",
}


def oracle(parts: str, select: str) -> str:
    """A SELECT over some of PARTS (names with spaces between)."""
    names = parts.split()
    if "q" in names:
        names = ["p", "sd", *names]
    if "p" in names and "m" not in names:
        names.insert(0, "m")
    return tables.plain("with " + ", ".join(f"{n} as ({PARTS[n]})" for n in names) + " " + select) if names else tables.plain(select)


def query(parts: str = "", select: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name, with its oracle if SQL can express it."""

    def register(f):
        _QUERIES[f.__name__] = f
        if select is not None:
            _ORACLES[f.__name__] = oracle(parts, select)
        return f

    return register


def oracle_sql_so_far() -> dict[str, str]:
    """The SQL of what is registered up to now, for queries that are put together from others."""
    return dict(_ORACLES)


def query_of(sql: Callable[[], str]):
    """Like query, with SQL that is put together from that of other queries."""

    def register(f):
        _QUERIES[f.__name__] = f
        _ORACLES[f.__name__] = sql()
        return f

    return register


def _load() -> None:
    from epochal.plans import feature_queries, kpi_queries, merge_queries, model_queries, page_queries, panel_queries, rating_queries, stream_queries, temporal_queries, text_queries, upkeep_queries  # noqa: F401


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel, form, pair history, lagged averages and ratings joined into one feature table."""
    from epochal.plans import flagship as plan

    return plan.features(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLES)
