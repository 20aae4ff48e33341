"""Nested match records to flat columns, and rosters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "struct<name:string,tier:bigint,division:bigint>"
_TEAM = "struct<name:string,goals:bigint>"
RECORD = (
    "struct<id:string,title:string,date:string,duration:bigint,overtime:boolean,overtime_seconds:bigint,map_code:string,map_name:string,match_type:string,team_size:bigint,season:bigint,season_type:string,playlist_id:string,"
    f"blue:{_TEAM},orange:{_TEAM},min_rank:{_RANK},max_rank:{_RANK},uploader:struct<name:string,steam_id:string>>"
)
PLAIN = ("duration", "overtime_seconds", "map_code", "map_name", "match_type", "team_size", "season", "season_type", "playlist_id", "date")


def flatten_record(df: DataFrame, column: str = "record") -> DataFrame:
    """27 flat columns from a JSON record; title and team names default to Unknown, overtime to 0."""
    r = df.select(F.from_json(column, RECORD).alias("r"))
    unknown = F.lit("Unknown")
    cols = [F.col("r.id").alias("replay_id"), F.coalesce("r.title", unknown).alias("title"), *[F.col(f"r.{c}").alias(c) for c in PLAIN], F.coalesce(F.col("r.overtime").cast("int"), F.lit(0)).alias("overtime")]
    for side in ("blue", "orange"):
        cols += [F.coalesce(f"r.{side}.name", unknown).alias(f"{side}_team"), F.col(f"r.{side}.goals").alias(f"{side}_goals")]
    for end in ("min", "max"):
        cols += [F.col(f"r.{end}_rank.{a}").alias(f"{end}_rank{b}") for a, b in (("name", ""), ("tier", "_tier"), ("division", "_division"))]
    return r.select(*cols, F.col("r.uploader.name").alias("uploader_name"), F.col("r.uploader.steam_id").alias("uploader_steam_id"))


def short_metadata(replay_id: Column, replay_title: Column, title: Column, blue: Column, orange: Column, date: Column, source: str = "ballchasing") -> Column:
    unknown = F.lit("Unknown")
    return F.struct(replay_id.alias("id"), F.coalesce(replay_title, title, unknown).alias("title"), F.coalesce(blue, unknown).alias("blue"), F.coalesce(orange, unknown).alias("orange"), F.coalesce(date, unknown).alias("date"), F.lit(source).alias("source"))


#: fixed values: output name and header key of the extracted fields
HEADER = {
    "ballchasing_id": "Id", "replay_name": "ReplayName", "date": "Date", "map": "MapName", "match_type": "MatchType", "team_size": "TeamSize", "num_frames": "NumFrames",
    "team_0_score": "Team0Score", "team_1_score": "Team1Score", "goals": "Goals", "highlights": "HighLights", "game_version": "BuildVersion",
}


def header_map(pairs: Column) -> Column:
    """Map of (key, value) pairs; the last of equal keys wins, without a session setting."""
    back = F.reverse(pairs)
    return F.map_from_entries(F.filter(back, lambda p, i: F.array_position(F.transform(back, lambda x: x["key"]), p["key"]) == i + 1))


def header_fields(df: DataFrame, keys: list[str], pairs: str) -> DataFrame:
    """keys and the 12 header fields as strings; a missing field is NULL, missing goals and highlights are `[]`."""
    m = df.select(*keys, header_map(F.coalesce(F.col(pairs), F.array().cast("array<struct<key:string,value:string>>"))).alias("__m"))

    def field(name: str) -> Column:
        value = F.try_element_at("__m", F.lit(HEADER[name]))
        return (F.coalesce(value, F.lit("[]")) if name in ("goals", "highlights") else value).alias(name)

    return m.select(*keys, *[field(n) for n in HEADER])


def player_mapping(df: DataFrame, keys: list[str], team_zero: str, team_one: str) -> DataFrame:
    """Rows (keys, slot, team, name, steam_id, stats) of players struct(name, remote_id map, stats map): team zero in order, then team one.

    A missing name stays NULL; steam_id is the entry `Steam` of remote_id, NULL where there is none; missing stats are an empty map.
    """
    out = roster(df, keys, team_zero, team_one)
    stats = F.col("player.stats")
    kind = next(f.dataType for f in df.schema[team_zero].dataType.elementType.fields if f.name == "stats")
    return out.select(*keys, "slot", "team", F.col("player.name").alias("name"), F.try_element_at("player.remote_id", F.lit("Steam")).alias("steam_id"), F.coalesce(stats, F.create_map().cast(kind)).alias("stats"))


def roster(df: DataFrame, keys: list[str], team_zero: str, team_one: str) -> DataFrame:
    """Rows (keys, slot, team, player): team zero in order, then team one; missing lists are empty."""

    def tagged(column: str, team: int) -> Column:
        return F.transform(F.coalesce(F.col(column), F.array()), lambda p: F.struct(F.lit(team).alias("team"), p.alias("player")))

    out = df.select(*keys, F.posexplode(F.concat(tagged(team_zero, 0), tagged(team_one, 1))).alias("slot", "entry"))
    return out.select(*keys, "slot", "entry.team", "entry.player")


def roster_defaults(df: DataFrame, key: str, n: str, mapping: DataFrame) -> DataFrame:
    """Every slot below n: name `Player i` and team by halves where the mapping lacks it; a known slot without team is team 0."""
    slots = df.select(key, F.col(n).alias("__n"), F.explode(F.sequence(F.lit(0), F.col(n) - 1)).alias("slot"))
    m = mapping.select(F.col(key).alias("__k"), F.col("slot").alias("__slot"), F.col("name").alias("__name"), F.col("team").alias("__team"), F.lit(True).alias("__known"))
    out = slots.join(m, (F.col(key) == F.col("__k")) & (F.col("slot") == F.col("__slot")), "left")
    half = F.when(F.col("slot") < F.floor(F.col("__n") / 2), 0).otherwise(1)
    return out.select(key, "slot", F.coalesce("__name", F.concat(F.lit("Player "), F.col("slot"))).alias("name"), F.when(F.col("__known"), F.coalesce("__team", F.lit(0))).otherwise(half).cast("int").alias("team"))


def order_in_team(df: DataFrame, keys: list[str], team: str, slot: str) -> DataFrame:
    """df with team_order, a player's place in the own team, and colour = place mod 4."""
    place = F.row_number().over(Window.partitionBy(*keys, team).orderBy(slot)) - 1
    return df.withColumn("team_order", place.cast("long")).withColumn("colour", F.col("team_order") % 4)
