"""Raw frame arrays to named columns, quality of frames, positions and directions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..plans import registry


def deduplicate(df: DataFrame, names: list[str], values: str = "values", keep: list[str] | None = None, **flags: bool) -> DataFrame:
    """Columns keep, then one column per kept name of the positional array; positions are fixed on the driver.

    The first of repeated names wins; an array too short gives NULL.
    """
    cols = [F.try_element_at(F.col(values), F.lit(at + 1)).alias(name) for at, name in registry.kept_positions(names, **flags)]
    return df.select(*(keep or []), *cols)


def padded(df: DataFrame, num_players: int = 8, preset: str = "standard") -> DataFrame:
    """Wide frames with every column of num_players players; absent ones NULL, so that player counts can be mixed."""
    want = [n for _, n in registry.kept_positions(registry.preset_columns(preset, num_players))]
    return df.select(*[F.col(f"`{c}`") for c in df.columns], *[F.lit(None).cast("double").alias(c) for c in want if c not in df.columns])


def classify(name: Column) -> Column:
    """Class of a raw column name, as registry.column_class, for tables of names."""
    bare = F.regexp_replace(name, "^(Ball - |i )", "")
    return F.when(bare.contains("quaternion"), "quaternion").when(bare.contains("velocity"), "velocity").when(bare.rlike("^position [xyz]$"), "position").when(bare.rlike("^rotation [xyz]$"), "euler").otherwise("other")


def feature_series(df: DataFrame, ids: list[str], features: list[str]) -> DataFrame:
    """Long rows (ids, feature, value) of those features that df has."""
    have = [f for f in features if f in df.columns]
    return df.unpivot(ids, have, "feature", "value")


def frame_slice(df: DataFrame, start: int, end: int, index: str = "frame") -> DataFrame:
    """Frames from start up to, not including, end."""
    return df.filter((F.col(index) >= start) & (F.col(index) < end))


def nan_count(values: Column) -> Column:
    return F.size(F.filter(values, lambda v: F.isnan(v))).cast("long")


def inf_count(values: Column) -> Column:
    return F.size(F.filter(values, lambda v: F.abs(v) == float("inf"))).cast("long")


def verdict(frames: Column, players: Column, low: int = 100, high: int = 100_000, fewest: int = 2, most: int = 8) -> Column:
    """First failed check, or ok; bounds themselves are ok."""
    return F.when(frames < low, "too few frames").when(frames > high, "too many frames").when(players < fewest, "too few players").when(players > most, "too many players").otherwise("ok")


def warnings(nans: Column, infs: Column, columns: Column, expected: Column | None = None) -> Column:
    """Soft findings as an array; column counts are compared only where an expectation is given."""
    off = F.lit(None).cast("string") if expected is None else F.when(columns != expected, F.lit("column count"))
    return F.array_compact(F.array(F.when(nans > 0, F.lit("NaN values")), F.when(infs > 0, F.lit("Inf values")), off))


def format_outcome(parsed: Column, check: Column, rows: Column, columns: Column) -> Column:
    """Outcome of formatting: failed parse -1 counts, failed check its reason, else the counts."""
    fine = parsed & (check == "ok")
    return F.struct(
        fine.alias("success"),
        F.when(~parsed, "Parse failed").when(check != "ok", F.concat(F.lit("Validation failed: "), check)).alias("error"),
        F.when(~parsed, -1).when(fine, rows).otherwise(0).cast("long").alias("rows"),
        F.when(~parsed, -1).when(fine, columns).otherwise(0).cast("long").alias("columns"),
    )


def duration(frames: Column, fps: Column) -> Column:
    """Seconds; 0 unless both are positive."""
    return F.when((frames > 0) & (fps > 0), frames / fps).otherwise(F.lit(0.0))


def player_count(team_zero: str, team_one: str) -> Column:
    """Members of both lists; a missing list counts 0."""
    return sum((F.size(F.coalesce(F.col(c), F.array())) for c in (team_zero, team_one)), F.lit(0))


def player_count_fallback(told: Column, mapped: Column, team_size: Column) -> Column:
    """Stated count, else mapped players if any, else twice the team size (default 3)."""
    return F.coalesce(told, F.nullif(mapped, F.lit(0)), F.coalesce(team_size, F.lit(3)) * 2)


def entity_position(x: Column, y: Column, z: Column) -> Column:
    """struct(x, y, z), or NULL if any is NULL or NaN."""
    whole = x.isNotNull() & y.isNotNull() & z.isNotNull() & ~F.isnan(x) & ~F.isnan(y) & ~F.isnan(z)
    return F.when(whole, F.struct(x.alias("x"), y.alias("y"), z.alias("z")))


def forward(x: Column, y: Column, z: Column, w: Column) -> Column:
    """(0, 1, 0) turned by a scalar-last quaternion, normalised first; NULL for a NULL part or zero norm."""
    n = x * x + y * y + z * z + w * w

    def over(v: Column) -> Column:
        return 2 * v / n

    return F.when(n > 0, F.struct(over(x * y - z * w).alias("x"), (1 - over(x * x + z * z)).alias("y"), over(y * z + x * w).alias("z")))


def float32(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """df with columns (all numeric ones if None) as 32-bit floats, in their order."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)} if columns is None else set(columns)
    return df.select(*[F.col(f"`{c}`").cast("float").alias(c) if c in numeric else F.col(f"`{c}`") for c in df.columns])


def entity_frames(df: DataFrame, keys: list[str], players: str, values: str = "values", preset: str = "standard", **flags: bool) -> DataFrame:
    """Long layout of positional arrays: rows (keys, entity, slot, global columns, entity columns), one for the ball and one a player.

    entity is `ball` (slot -1) or `p0`, `p1`, ...; entity columns are the names without prefix that the ball or a
    player has, NULL where the entity lacks it.  The place of a value is (globals + slot * columns of a player + place
    within the player), so one plan serves any number of players: the column `players` says how many.
    Of repeated names the first place counts, as in deduplicate; a short array gives NULL; no or NULL players: ball only.
    """
    shared, own = (registry.PARSE_PRESETS[preset][k] for k in (0, 1))
    g = registry.raw_columns(shared, [], 0)
    p = [c for group in own for c in registry.PLAYER_GROUPS[group]]
    ball = {n.removeprefix(registry.BALL): at for at, n in registry.kept_positions(g, **flags) if n.startswith(registry.BALL)}
    common = {n: at for at, n in registry.kept_positions(g, **flags) if not n.startswith(registry.BALL)}
    player = {n: at for at, n in registry.kept_positions(p, **flags)}
    last = F.greatest(F.coalesce(F.col(players), F.lit(0)), F.lit(0)).cast("int") - 1
    rows = df.select(*keys, F.col(values).alias("__values"), F.explode(F.sequence(F.lit(-1), last)).alias("slot"))

    def value(at: Column | int) -> Column:
        return F.try_element_at("__values", (at if isinstance(at, Column) else F.lit(at)) + 1)

    def of_entity(name: str) -> Column:
        out = F.when(F.col("slot") < 0, value(ball[name])) if name in ball else F.when(F.lit(False), value(0))
        return (out.when(F.col("slot") >= 0, value(len(g) + F.col("slot") * len(p) + player[name])) if name in player else out).alias(name)

    names = list(dict.fromkeys([*ball, *player]))
    return rows.select(*keys, F.when(F.col("slot") < 0, "ball").otherwise(F.concat(F.lit("p"), F.col("slot"))).alias("entity"), "slot", *[value(at).alias(n) for n, at in common.items()], *map(of_entity, names))


def entity_poses(long: DataFrame, keys: list[str]) -> DataFrame:
    """Rows (keys, entity, slot, position, forward) of a long layout: struct(x, y, z) each, NULL where a part is missing; the ball has no forward vector."""
    x, y, z = (F.col(f"`position {a}`") for a in "xyz")
    turn = [F.col(f"`quaternion {a}`") for a in "xyzw"]
    whole = F.lit(True)
    for q in turn:
        whole = whole & q.isNotNull() & ~F.isnan(q)
    return long.select(*keys, "entity", "slot", entity_position(x, y, z).alias("position"), F.when((F.col("slot") >= 0) & whole, forward(*turn)).alias("forward"))
