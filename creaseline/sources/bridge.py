"""Match data derived from the generic test tables.

`lineitem` becomes balls (60 order keys form a match), `events` becomes live balls.
Everything is a row-local projection except `ball_num`, which needs the ball order.
"""

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from creaseline.schemas import MATCH_COLUMNS

# Explicit schemas: no job to read footers before planning.
LINES = ("l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, l_extendedprice DOUBLE, "
         "l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING")
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"

# Fixed values of the bridge: facts of match number `m`.
_MATCH_FACTS = [
    ("k1", "m % 25"),
    ("k2", "(m + 1 + (m div 25) % 24) % 25"),
    ("match_id", "'match_' || m"),
    ("match_type", "CASE WHEN m % 4 <= 1 THEN 'T20' WHEN m % 4 = 2 THEN 'ODI' ELSE 'Test' END"),
    ("team1", "CASE k1 WHEN 0 THEN 'India' WHEN 1 THEN 'Sri Lanka' WHEN 2 THEN 'Oman' ELSE 'T' || k1 || 'x XI' END"),
    ("team2", "CASE k2 WHEN 0 THEN 'India' WHEN 1 THEN 'Sri Lanka' WHEN 2 THEN 'Oman' ELSE 'T' || k2 || 'x XI' END"),
    ("venue", "CASE (m * 7) % 5 WHEN 0 THEN 'India Oval' WHEN 3 THEN 'T3x XI Park' ELSE 'T' || (m * 7) % 5 || 'x Oval' END"),
    ("match_date", "'2024-' || lpad(CAST(1 + m % 12 AS STRING), 2, '0') || '-' || lpad(CAST(1 + m % 28 AS STRING), 2, '0')"),
    ("winner", "CASE WHEN m % 17 = 0 THEN NULL WHEN (m * 31) % 5 < 3 THEN team1 ELSE team2 END"),
    ("toss_winner", "CASE WHEN (m * 13) % 7 < 3 THEN team1 ELSE team2 END"),
    ("toss_decision", "CASE WHEN m % 29 = 0 THEN NULL WHEN m % 3 = 0 THEN 'bat' ELSE 'field' END"),
    ("bat_first", "CASE WHEN (coalesce(toss_decision, 'bat') = 'bat') = (toss_winner = team1) THEN team1 ELSE team2 END"),
]

# Fixed values of the bridge: facts of one ball.
_BALL_FACTS = [
    ("inning", "CASE WHEN l_linestatus = 'F' THEN team1 ELSE team2 END"),
    ("fielding", "CASE WHEN l_linestatus = 'F' THEN team2 ELSE team1 END"),
    ("inning_no", "CASE WHEN inning = bat_first THEN 1 ELSE 2 END"),
    ("over_num", "CAST((l_partkey * 3 + l_linenumber) % 20 AS INT)"),
    # One batsman and one bowler of each team have a third of its balls.
    ("batsman", "inning || ' P' || CASE WHEN l_suppkey % 3 = 0 THEN 0 ELSE l_suppkey % 11 END"),
    ("bowler", "fielding || ' P' || CASE WHEN l_partkey % 3 = 0 THEN 0 ELSE l_partkey % 11 END"),
    ("non_striker", "inning || ' P' || (l_suppkey + 1 + l_linenumber) % 11"),
    ("runs_batsman", "element_at(array(0, 0, 0, 0, 0, 1, 1, 1, 2, 4, 6, 3), CAST(l_quantity AS INT) % 12 + 1)"),
    ("runs_extras", "CASE WHEN l_tax >= 0.065 THEN 1 ELSE 0 END"),
    ("runs_total", "runs_batsman + runs_extras"),
    ("wicket_kind", "CASE WHEN l_discount >= 0.085 AND l_returnflag <> 'N' THEN element_at(array('run out', 'bowled', "
                    "'caught', 'lbw', 'stumped', 'retired hurt', 'obstructing the field'), CAST(l_partkey % 7 AS INT) + 1) END"),
    ("wicket_player_out", "CASE WHEN wicket_kind = 'run out' AND l_linenumber % 2 = 0 THEN non_striker "
                          "WHEN wicket_kind IS NOT NULL THEN batsman END"),
]

BALL_COLUMNS = [
    *MATCH_COLUMNS, "inning", "inning_no", "over_num", "batsman", "bowler", "non_striker",
    "runs_batsman", "runs_extras", "runs_total", "wicket_kind", "wicket_player_out",
]


def _derive(df: DataFrame, facts: list[tuple[str, str]]) -> DataFrame:
    # One select: later facts refer to earlier ones by name.
    return df.select("*", *[F.expr(text).alias(name) for name, text in facts])


def read_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(LINES).parquet(f"{sf_dir}/lineitem.parquet")


def _with_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = read_lines(spark, sf_dir).withColumn("m", F.expr("l_orderkey div 60"))
    return _derive(lines, _MATCH_FACTS + _BALL_FACTS)


def balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat deliveries, without the position of a ball in its over."""
    return _with_order(spark, sf_dir).select(*BALL_COLUMNS)


def numbered_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat deliveries with `ball_num`. Real documents carry this order; the bridge has to sort each over."""
    over = Window.partitionBy("match_id", "inning", "over_num").orderBy("l_orderkey", "l_linenumber", "l_extendedprice")
    return (_with_order(spark, sf_dir)
            .withColumn("ball_num", F.row_number().over(over))
            .select(*BALL_COLUMNS, "ball_num"))


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per match: only the match number is shuffled, its facts are computed afterwards."""
    # The facts hang on an aggregate, not on the grouping key: Spark would move filters on the key to every ball.
    numbers = (read_lines(spark, sf_dir).groupBy(F.expr("l_orderkey div 60").alias("key"))
               .agg(F.max(F.expr("l_orderkey div 60")).alias("m")))
    return _derive(numbers, _MATCH_FACTS).select(*MATCH_COLUMNS)


def _info() -> F.Column:
    return F.struct(
        F.array("match_date").alias("dates"),
        F.struct(F.concat(F.lit("Cup "), F.substring("match_date", 6, 2)).alias("name")).alias("event"),
        F.col("match_type"),
        F.struct(F.col("winner")).alias("outcome"),
        F.substring("match_date", 1, 4).alias("season"),
        F.array("team1", "team2").alias("teams"),
        F.struct(F.col("toss_decision").alias("decision"), F.col("toss_winner").alias("winner")).alias("toss"),
        F.col("venue"),
    )


def match_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Match documents without innings, with two squads of eleven each."""
    number = F.regexp_extract("match_id", r"(\d+)$", 1).cast("bigint")
    squad = "transform(sequence(0, 10), i -> 'S' || (2 * ((n + i) % 40) + {odd}))"
    return matches(spark, sf_dir).withColumn("n", number).select(
        "match_id",
        F.concat(F.lit("/matches/"), "match_id", F.lit(".json")).alias("source_file"),
        _info().withField("players", F.create_map(
            F.col("team1"), F.expr(squad.format(odd=0)), F.col("team2"), F.expr(squad.format(odd=1)))).alias("info"),
    )


_DELIVERIES = ("array<struct<batter:string,bowler:string,non_striker:string,runs:struct<batter:int,extras:int,total:int>,"
               "wickets:array<struct<kind:string,player_out:string>>>>")


def match_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested match documents: both innings, all overs and all balls of a match.

    A match is bounded (60 order keys), and so are its arrays. Balls, overs and innings stand in their order; the
    team that bats second is in the second place even if the first has no ball. Only the columns of the lines are dealt out, once, by match;
    the facts and the arrays are made of them there. All facts of a match hang on its number.
    """
    number = F.expr("l_orderkey div 60")
    lines = read_lines(spark, sf_dir).repartition(number).withColumn("m", number)
    delivery = F.struct(
        "inning_no", "inning", "over_num", "l_orderkey", "l_linenumber", "l_extendedprice",
        F.struct(
            F.col("batsman").alias("batter"), "bowler", "non_striker",
            F.struct(F.col("runs_batsman").alias("batter"), F.col("runs_extras").alias("extras"),
                     F.col("runs_total").alias("total")).alias("runs"),
            F.when(F.col("wicket_kind").isNotNull(), F.array(F.struct(
                F.col("wicket_kind").alias("kind"), F.col("wicket_player_out").alias("player_out")))).alias("wickets"),
        ).alias("ball"),
    )
    # A team bats in one place only, so the order of the list puts the balls of an over together.
    listed = _derive(lines, _MATCH_FACTS + _BALL_FACTS).groupBy("m").agg(F.sort_array(F.collect_list(delivery)).alias("balls"))

    def begins(ball, at):
        before = F.get("balls", at - 1)
        return (at == 0) | ~ball["inning_no"].eqNullSafe(before["inning_no"]) | ~ball["over_num"].eqNullSafe(before["over_num"])

    starts = F.filter(F.transform("balls", lambda ball, at: F.when(begins(ball, at), at)), lambda at: at.isNotNull())

    def over(at, k):
        first, end = F.get("balls", at), F.coalesce(F.get("starts", k + 1), F.size("balls"))
        deliveries = F.transform(F.slice("balls", at + 1, end - at), lambda b: b["ball"])
        return F.struct(first["inning_no"].alias("inning_no"), first["inning"].alias("team"),
                        F.struct(first["over_num"].alias("over"), deliveries.alias("deliveries")).alias("row"))

    overs = listed.withColumn("starts", starts).select("m", F.transform("starts", over).alias("overs"))
    empty = F.struct(F.lit(None).cast("string").alias("team"), F.lit(None).cast(f"array<struct<over:int,deliveries:{_DELIVERIES}>>").alias("overs"))

    def place(number):
        own = F.filter("overs", lambda o: o["inning_no"] == number)
        return F.when(F.size(own) > 0, F.struct(F.get(own, F.lit(0))["team"].alias("team"), F.transform(own, lambda o: o["row"]).alias("overs"))).otherwise(empty)

    return _derive(overs, _MATCH_FACTS).select(
        "match_id",
        F.concat(F.lit("/matches/"), "match_id", F.lit(".json")).alias("source_file"),
        _info().alias("info"),
        F.array(place(1), place(2)).alias("innings"),
    )


def read_events(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    if not stream:
        return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")
    # A glob, because a file stream does not take the path of a single file.
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/events.parque[t]")


def live_from_events(events: DataFrame) -> DataFrame:
    """Live balls; (match_id, inning, over_num, ball_num) identifies one event."""
    run_of = F.get_json_object("props", "$.k").cast("int")
    wicket = F.col("event_type") == "error"
    player = F.concat(F.lit("P"), (F.col("user_id") % 11).cast("string"))
    return (events
            .withColumn("runs_total", run_of % 7)
            .withColumn("runs_extras", F.when((F.col("event_type") == "view") & (F.col("runs_total") > 0), 1).otherwise(0))
            .select(
                F.concat(F.lit("L"), (F.col("user_id") % 8).cast("string")).alias("match_id"),
                F.expr("'Innings ' || event_id div 120").alias("inning"),
                F.expr("CAST((event_id div 6) % 20 AS INT)").alias("over_num"),
                F.expr("CAST(event_id % 6 + 1 AS INT)").alias("ball_num"),
                player.alias("batsman"),
                F.concat(F.lit("B"), (F.col("event_id") % 11).cast("string")).alias("bowler"),
                (F.col("runs_total") - F.col("runs_extras")).alias("runs_batsman"),
                "runs_extras", "runs_total",
                F.when(wicket, F.lit("bowled")).alias("wicket_kind"),
                F.when(wicket, player).alias("wicket_player_out"),
                wicket.alias("is_wicket"),
                F.col("ts").cast("timestamp").alias("event_time"),
            ))


def live_balls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live_from_events(read_events(spark, sf_dir))


def envelopes_from_events(events: DataFrame) -> DataFrame:
    """Messages of the live-ball topic; wickets alternate between the object and the array shape."""
    live = live_from_events(events)
    wicket = F.struct(F.col("wicket_kind").alias("kind"), F.col("wicket_player_out").alias("player_out"))

    def message(shape):
        return F.to_json(F.struct(
            F.col("match_id").alias("matchId"), "inning", F.col("over_num").alias("over"), F.col("ball_num").alias("ball"),
            "batsman", "bowler",
            F.struct(F.col("runs_batsman").alias("batsman"), F.col("runs_extras").alias("extras"),
                     F.col("runs_total").alias("total")).alias("runs"),
            shape.alias("wicket"),
            F.date_format("event_time", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("eventTime"),
        ))

    value = (F.when(F.col("ball_num") % 2 == 0, message(F.when(F.col("is_wicket"), wicket)))
             .otherwise(message(F.when(F.col("is_wicket"), F.array(wicket)))))
    return live.select(F.col("match_id").alias("key"), value.alias("value"), F.lit("live-balls").alias("topic"))


def envelopes(spark: SparkSession, sf_dir: str, stream: bool = False) -> DataFrame:
    return envelopes_from_events(read_events(spark, sf_dir, stream))
