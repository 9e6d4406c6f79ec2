"""Input tables, and their mapping into the shape of two-sided matches.

The SQL of the mapping is plain enough to run on other engines word for word, which the oracles of
the query registry rely on.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Matches: id, week, tournament, round (6..11, 11 the final), winner, loser, surface, retirement mark.
MATCHES = """
select o_orderkey as id,
  cast(date_trunc('week', o_orderdate) as date) as start_dtm,
  concat(cast(cast(date_trunc('week', o_orderdate) as date) as string), '-', cast(o_orderkey % 3 as string)) as tournament_id,
  cast(o_orderkey % 6 + 6 as int) as rnd,
  cast(o_custkey % 150 as int) as winner,
  cast((o_custkey + 1 + o_orderkey % 149) % 150 as int) as loser,
  case substr(o_orderpriority, 1, 1) when '1' then 'Hard' when '2' then 'Clay' when '3' then 'Grass' when '4' then 'Carpet' end as surface,
  case when o_orderkey % 29 = 0 then '(RET)' when o_orderkey % 31 = 0 then '(W/O)' end as match_ret
from {orders}
"""

#: Raw statistics of a match, from its lines: made and total of one kind for either side; null without lines.
STATS = """
select l_orderkey as id,
  cast(sum(case when l_returnflag = 'N' then cast(l_quantity as bigint) end) as bigint) as won_points,
  cast(sum(cast(l_quantity as bigint)) as bigint) as all_points,
  cast(sum(case when l_linestatus = 'F' then cast(l_quantity as bigint) end) as bigint) as lost_points,
  cast(count(*) as bigint) as sets_played,
  cast(sum(case when l_returnflag = 'R' then 1 else 0 end) as bigint) as aces
from {lineitem} group by l_orderkey
"""

#: Serve and return counts of each side of a match, from its lines; null without lines that count.
COUNTS = (
    "aces double_faults first_serves_in first_serves_total first_serve_points_won first_serve_points_total second_serve_points_won second_serve_points_total "
    "break_points_saved break_points_serve_total service_points_won service_points_total service_games_played first_serve_return_won first_serve_return_total "
    "second_serve_return_won second_serve_return_total break_points_converted break_points_return_total return_games_played return_points_won return_points_total "
    "total_points_won total_points_total games_won tiebreaks_won sets_won"
).split()


def _count(k: int, name: str, side: int) -> str:
    some = "" if name.endswith(("total", "played")) else f"case when (l_linenumber + {k + side}) % 3 <> 0 then "
    return f"cast(sum({some}cast(l_quantity as bigint) * {1 + (k + side) % 4}{' end' if some else ''}) as bigint) as {'wl'[side]}_{name}"


SIDES = "select l_orderkey as id, " + ", ".join(_count(k, c, side) for side in (0, 1) for k, c in enumerate(COUNTS)) + " from {lineitem} where l_orderkey % 37 <> 0 group by l_orderkey"

#: Ranking snapshots: each month, players by what they spent in it.
RANKINGS = """
select player_code, snapshot_date, cast(row_number() over (partition by snapshot_date order by total desc, player_code) as int) as ranking
from (select cast(o_custkey % 150 as int) as player_code, cast(date_trunc('month', o_orderdate) as date) as snapshot_date,
        sum(cast(o_totalprice as decimal(18, 2))) as total
      from {orders} group by 1, 2) as monthly
"""

#: Players: one row a code, from the customer with the smallest key of it.
PLAYERS = """
select cast(c_custkey % 150 as int) as player_code, c_name as player_name, n_name as citizenship, r_name as continent,
  cast(1985 + c_custkey % 30 as int) as turned_pro
from {customer} join {nation} on c_nationkey = n_nationkey join {region} on n_regionkey = r_regionkey
where c_custkey in (select min(c_custkey) from {customer} group by c_custkey % 150)
"""

#: Tournaments: name, country and category of each tournament_id.
TOURNAMENTS = """
select tournament_id, start_dtm, n_name as country, r_name as continent, kind as category, indoor from (
  select tournament_id, min(start_dtm) as start_dtm, cast(min(id) % 25 as int) as nation,
    case cast(min(id) % 4 as int) when 0 then 'gs' when 1 then '1000' when 2 then 'atp500' else 'atp250' end as kind,
    case when min(id) % 2 = 0 then 'Indoor' else 'Outdoor' end as indoor
  from ({matches}) as m group by tournament_id) as t
join {nation} on nation = n_nationkey join {region} on n_regionkey = r_regionkey
"""

NAMES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def run(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """A mapping over the tables of a folder."""
    sql = sql.replace("{matches}", MATCHES)
    return spark.sql(sql, **{n: table(spark, sf_dir, n) for n in NAMES if "{" + n + "}" in sql})


def plain(sql: str) -> str:
    """The same text for an engine that has the tables as views."""
    sql = sql.replace("{matches}", MATCHES)
    for n in NAMES:
        sql = sql.replace("{" + n + "}", n)
    return sql.strip()


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, MATCHES)


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, STATS)


def side_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four sums a match, that side_counts are made of: of all lines, and of those but every third."""
    size, third = F.col("l_quantity").cast("long"), F.pmod(F.col("l_linenumber"), F.lit(3))
    sums = [F.sum(size).alias("_all"), *[F.sum(F.when(third != r, size)).alias(f"_but_{r}") for r in range(3)]]
    return table(spark, sf_dir, "lineitem").filter("l_orderkey % 37 <> 0").groupBy(F.col("l_orderkey").alias("id")).agg(*sums)


def side_counts() -> list[Column]:
    """The 54 counts of both sides, in place, from the columns of side_sums."""

    def count(k: int, name: str, side: int) -> Column:
        of = "_all" if name.endswith(("total", "played")) else f"_but_{-(k + side) % 3}"
        return (F.col(of) * (1 + (k + side) % 4)).alias(f"{'wl'[side]}_{name}")

    return [count(k, c, side) for side in (0, 1) for k, c in enumerate(COUNTS)]


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of SIDES. Each of its counts is a multiple of a match's sum of all lines, or of those but every third: four
    sums a match are made and moved, and the 54 counts follow from them in place."""
    return side_sums(spark, sf_dir).select("id", *side_counts())


def rankings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, RANKINGS)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, PLAYERS)


def tournaments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run(spark, sf_dir, TOURNAMENTS)
