"""Jet features and the statistics of an event over its jets."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierframe.functions import scalar as S
from tierframe.operators.stats import Stat, wide_group_stats, with_wide_group_stats

KEY = "event_id"
COUNT = "number_of_particles_in_this_jet"

# direction -> the column that holds the length along it
LENGTH = {
    "x": "jet_px",
    "y": "jet_py",
    "z": "jet_pz",
    "xy": "xy_dis",
    "yz": "yz_dis",
    "zx": "zx_dis",
}
DIRECTIONS = list(LENGTH)
ANGLES = ["xy", "yx", "yz", "zy", "zx", "xz"]
# quantities that get one projection per direction, with their own column
PROJECTED = {
    "energy": "jet_energy",
    "mass": "jet_mass",
    "speed": "jet_speed",
    "mv": "jet_mv",
    "particle_mv": "particle_mv",
}


def jet_features(df: DataFrame) -> DataFrame:
    """Raw columns plus 58 features; negative mass counts as 0 throughout."""
    momentum = {axis: F.col(f"jet_p{axis}") for axis in "xyz"}
    base = df.withColumn("jet_mass", S.clamp_negative(F.col("jet_mass"))).withColumns(
        {
            "jet_distance": S.norm(*momentum.values()),
            **{f"{a}{b}_dis": S.norm(momentum[a], momentum[b]) for a, b in ("xy", "yz", "zx")},
            **{f"angle_{a}{b}": S.angle(momentum[a], momentum[b]) for a, b in ANGLES},
            "mean_particles_mass": S.ratio(F.col("jet_mass"), F.col(COUNT)),
            "mean_particles_energy": S.ratio(F.col("jet_energy"), F.col(COUNT)),
            "jet_speed": S.speed(F.col("jet_energy"), F.col("jet_mass")),
        }
    )
    moving = base.withColumns(
        {
            **{
                f"{d}_div_dist": S.ratio(F.col(length), F.col("jet_distance"))
                for d, length in LENGTH.items()
            },
            "jet_mv": F.col("jet_mass") * F.col("jet_speed"),
            "time_dis": S.travel_time(F.col("jet_distance"), F.col("jet_speed")),
        }
    ).withColumn("particle_mv", S.ratio(F.col("jet_mv"), F.col(COUNT)))
    projected = moving.withColumns(
        {
            f"{quantity}_{d}": F.col(source) * F.col(f"{d}_div_dist")
            for quantity, source in PROJECTED.items()
            for d in DIRECTIONS
        }
    )
    return projected.withColumns(
        {
            f"time_{d}": S.travel_time(F.col(length), F.col(f"speed_{d}"))
            for d, length in LENGTH.items()
        }
    )


def _event_families() -> dict[str, str]:
    """Family name -> source column of the 64 event statistics."""
    families = {"number_particles": COUNT, "mass": "jet_mass", "energy": "jet_energy"}
    for quantity in ("mass", "energy"):
        families |= {f"{quantity}_{d}": f"{quantity}_{d}" for d in DIRECTIONS}
    families |= {f"particles_{q}": f"mean_particles_{q}" for q in ("mass", "energy")}
    families["distance"] = "jet_distance"
    families |= {f"{plane}_dis": f"{plane}_dis" for plane in ("xy", "yz", "zx")}
    families |= {f"{d}_div_dist": f"{d}_div_dist" for d in DIRECTIONS}
    families["speed"] = "jet_speed"
    families |= {f"speed_{d}": f"speed_{d}" for d in DIRECTIONS}
    families |= {f"p{axis}": f"jet_p{axis}" for axis in "xyz"}
    families |= {f"angle_{pair}": f"angle_{pair}" for pair in ANGLES}
    families |= {f"time_{d}": f"time_{d}" for d in ["dis", *DIRECTIONS]}
    for quantity, source in (("mv", "jet_mv"), ("particle_mv", "particle_mv")):
        families[quantity] = source
        families |= {f"{quantity}_{d}": f"{quantity}_{d}" for d in DIRECTIONS}
    return families


EVENT_FAMILIES = _event_families()
FOUR = ("max", "mean", "min", "std")


def _event_stat_list(kinds: tuple[str, ...], digits: int | None) -> list[Stat]:
    return [Stat(source, family, kinds, digits) for family, source in EVENT_FAMILIES.items()] + [
        Stat("jet_energy", "energy", ("sum",)),
        Stat("jet_mass", "mass", ("sum",)),
    ]


def event_stats(
    jets: DataFrame,
    kinds: tuple[str, ...] = FOUR,
    digits: int | None = None,
) -> DataFrame:
    """One row per event over all of its raw jets: count, the families, sums
    and the speed of the whole event.  ``kinds`` narrows the families and
    ``digits`` rounds their means."""
    count = ("count(jet_id) AS event_id_count",)
    stats = _event_stat_list(kinds, digits)
    grouped = wide_group_stats(jets, KEY, stats, count, jet_features)
    return with_event_speed(grouped)


def jet_table(
    jets: DataFrame,
    kinds: tuple[str, ...] = FOUR,
    digits: int | None = None,
) -> DataFrame:
    """Every jet with its features and the statistics of its event."""
    count = {"event_id_count": "count(jet_id)"}
    stats = _event_stat_list(kinds, digits)
    return with_event_speed(
        with_wide_group_stats(jets, KEY, stats, count, jet_features)
    )


def with_event_speed(df: DataFrame) -> DataFrame:
    speed = S.speed(F.col("event_id_energy_sum"), F.col("event_id_mass_sum"))
    return df.withColumn("event_id_speed", speed)
