"""Column names of frames: feature groups, presets, classes of columns and physical bounds (driver-side only)."""

from __future__ import annotations

XYZ, XYZW = ("x", "y", "z"), ("x", "y", "z", "w")


def axes(name: str, over: tuple[str, ...] = XYZ) -> list[str]:
    return [f"{name} {a}" for a in over]


def _body(prefix: str = "", turn: str = "rotation", over: tuple[str, ...] = XYZW, moving: bool = False) -> list[str]:
    """Position and orientation of a rigid body, with velocities if moving."""
    out = axes(f"{prefix}position") + axes(f"{prefix}{turn}", over)
    return out + (axes(f"{prefix}linear velocity") + axes(f"{prefix}angular velocity") if moving else [])


BALL = "Ball - "
#: fixed values: names of feature groups and of their columns
GLOBAL_GROUPS = {
    "BallRigidBody": _body(BALL, over=XYZ, moving=True),
    "BallRigidBodyNoVelocities": _body(BALL),
    "BallRigidBodyQuaternions": _body(BALL, "quaternion"),
    "CurrentTime": ["current time"],
    "FrameTime": ["frame time"],
    "SecondsRemaining": ["seconds remaining"],
    "InterpolatedBallRigidBodyNoVelocities": _body(BALL),
    "VelocityAddedBallRigidBodyNoVelocities": _body(BALL),
}
PLAYER_GROUPS = {
    "PlayerAnyJump": ["any_jump_active"],
    "PlayerBoost": ["boost level"],
    "PlayerDemolishedBy": ["player demolished by"],
    "PlayerJump": ["dodge active", "jump active", "double jump active"],
    "PlayerRigidBody": _body(over=XYZ, moving=True),
    "PlayerRigidBodyNoVelocities": _body(),
    "PlayerRigidBodyQuaternions": _body(turn="quaternion"),
    "VelocityAddedPlayerRigidBodyNoVelocities": _body(),
    "InterpolatedPlayerRigidBodyNoVelocities": _body("i "),
}
#: fixed values: parse presets as (global groups, player groups)
PARSE_PRESETS = {
    "standard": (["CurrentTime", "FrameTime", "SecondsRemaining", "BallRigidBody", "BallRigidBodyQuaternions"], ["PlayerRigidBody", "PlayerRigidBodyQuaternions", "PlayerBoost", "PlayerJump", "PlayerDemolishedBy"]),
    "minimal": (["CurrentTime", "BallRigidBody"], ["PlayerRigidBody", "PlayerBoost", "PlayerAnyJump", "PlayerDemolishedBy"]),
    "all": (list(GLOBAL_GROUPS), list(PLAYER_GROUPS)),
}
#: fixed values: play field, ball and car limits; first match by substring wins
BOUNDS = (("position x", 4096.0, 4096.0), ("position y", 5120.0, 5120.0), ("position z", 2044.0, 2044.0), ("linear velocity", 6000.0, 2300.0), ("angular velocity", 6.0, 5.5), ("boost level", 255.0, 255.0))


def raw_columns(global_groups: list[str], player_groups: list[str], num_players: int) -> list[str]:
    """Names by position in a raw frame array, repeats included."""
    unknown = [g for g in global_groups if g not in GLOBAL_GROUPS] + [g for g in player_groups if g not in PLAYER_GROUPS]
    if unknown:
        raise ValueError(f"unknown feature groups: {unknown}")
    own = [c for g in player_groups for c in PLAYER_GROUPS[g]]
    return [c for g in global_groups for c in GLOBAL_GROUPS[g]] + [f"p{i}_{c}" for i in range(num_players) for c in own]


def expected_count(global_groups: list[str], player_groups: list[str], num_players: int) -> int:
    """Columns of a raw frame array before repeats are dropped; an unknown group is a KeyError."""
    shared, own = (sum(len(known[g]) for g in groups) for known, groups in ((GLOBAL_GROUPS, global_groups), (PLAYER_GROUPS, player_groups)))
    return shared + num_players * own


def preset_columns(preset: str, num_players: int) -> list[str]:
    if preset not in PARSE_PRESETS:
        raise ValueError(f"unknown preset {preset!r}; one of {sorted(PARSE_PRESETS)}")
    return raw_columns(*PARSE_PRESETS[preset], num_players)


def column_class(name: str) -> str:
    """quaternion, velocity, position, euler or other; `rotation w` is other."""
    bare = name
    for prefix in (BALL, "i "):
        if bare.startswith(prefix):
            bare = bare[len(prefix) :]
            break
    for part in ("quaternion", "velocity"):
        if part in bare:
            return part
    return "position" if bare in axes("position") else "euler" if bare in axes("rotation") else "other"


def kept_positions(names: list[str], keep_velocity: bool = True, keep_euler: bool = False, keep_quaternion: bool = True) -> list[tuple[int, str]]:
    """(position, name) of the first occurrence of each name whose class is kept."""
    keep = {"velocity": keep_velocity, "euler": keep_euler, "quaternion": keep_quaternion}
    first: dict[str, int] = {}
    for at, name in enumerate(names):
        bare = name.split("_", 1)[1] if name[:1] == "p" and name.split("_", 1)[0][1:].isdigit() else name
        if keep.get(column_class(bare), True):
            first.setdefault(name, at)
    return [(at, name) for name, at in first.items()]


def select_columns(preset: str, num_players: int = 6) -> list[str]:
    """Columns of a selection preset: physics, minimal or full."""
    if preset not in ("physics", "minimal", "full"):
        raise ValueError(f"unknown preset {preset!r}; one of physics, minimal, full")
    moving = ["position", "linear velocity"] + ([] if preset == "minimal" else ["angular velocity"])

    def entity(prefix: str) -> list[str]:
        return [c for m in moving for c in axes(prefix + m)] + ([] if preset == "minimal" else axes(prefix + "quaternion", XYZW))

    out = (["frame", "current time", "frame time", "seconds remaining"] if preset == "full" else []) + entity(BALL)
    for i in range(num_players):
        p = f"p{i}_"
        out += [*entity(p), f"{p}boost level"]
        if preset == "full":
            out += [p + c for c in ("dodge active", "jump active", "double jump active", "player demolished by")]
    return out


def divisor(name: str) -> float | None:
    """Physical bound of a column, None where it has none."""
    for part, ball, player in BOUNDS:
        if part in name:
            return ball if name.startswith(BALL) else player
    return None
