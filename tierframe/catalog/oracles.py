"""SQL counterparts of the registered queries, for DuckDB on the same tables."""

from __future__ import annotations

PARTICLE = """
particle AS (
  SELECT l_orderkey AS jet_id,
         CASE WHEN l_returnflag = 'R' THEN -l_linenumber ELSE l_linenumber END
           AS particle_category,
         l_quantity - 25 AS particle_px,
         CAST(l_linenumber - 4 AS DOUBLE) AS particle_py,
         round(l_discount * 100) - 5 + 0.0 AS particle_pz,
         round(l_extendedprice * 100) + 0.0 AS particle_energy,
         round(l_tax * 100) - 2 + 0.0 AS particle_mass,
         l_linenumber AS line_number, l_partkey AS part_key,
         l_suppkey AS supplier_key, l_extendedprice AS price, l_shipdate AS shipped
  FROM lineitem)"""

JET = """
jet_sum AS (
  SELECT jet_id, count(*) AS n, sum(particle_px) AS jet_px, sum(particle_py) AS jet_py,
         sum(particle_pz) AS jet_pz, sum(particle_energy) AS jet_energy,
         sum(particle_mass) AS jet_mass
  FROM particle GROUP BY jet_id),
jet AS (
  SELECT o_orderkey AS jet_id, o_custkey AS event_id,
         CAST(coalesce(n, 0) AS INTEGER) AS number_of_particles_in_this_jet,
         jet_px, jet_py, jet_pz, jet_energy, jet_mass,
         CASE WHEN c_nationkey < 20 THEN
           CASE o_custkey % 4 WHEN 0 THEN 21 WHEN 1 THEN 1 WHEN 2 THEN 4 ELSE 5 END
         END AS label,
         CASE WHEN c_nationkey >= 20 THEN 'test' ELSE 'train' END AS split
  FROM orders JOIN customer ON o_custkey = c_custkey
       LEFT JOIN jet_sum ON jet_sum.jet_id = o_orderkey)"""

EVENT = """
event AS (
  SELECT c_custkey AS event_id, CAST(count(o_orderkey) AS INTEGER) AS number_of_jet_in_this_event,
         CASE WHEN c_nationkey < 20 THEN
           CASE c_custkey % 4 WHEN 0 THEN 21 WHEN 1 THEN 1 WHEN 2 THEN 4 ELSE 5 END
         END AS label,
         CASE WHEN c_nationkey >= 20 THEN 'test' ELSE 'train' END AS split
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  GROUP BY c_custkey, c_nationkey)"""

PREDICTION = """
weighted AS (
  SELECT c_custkey AS id, m, ['lgb', 'xgb', 'cat', 'nn'][m + 1] AS model,
         CASE WHEN c_nationkey < 20 THEN c_custkey % 4 END AS truth,
         CASE WHEN c_nationkey >= 20 THEN 'test' ELSE 'train' END AS split,
         {weights}
  FROM customer, (SELECT unnest([0, 1, 2, 3]) AS m)),
prediction AS (
  SELECT *, w0 / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p0, w1 / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p1,
         w2 / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p2, w3 / CAST(w0 + w1 + w2 + w3 AS DOUBLE) AS p3,
         CASE WHEN w0 >= greatest(w1, w2, w3) THEN 0 WHEN w1 >= greatest(w2, w3) THEN 1
              WHEN w2 >= w3 THEN 2 ELSE 3 END AS winner
  FROM weighted)""".format(
    weights=", ".join(
        f"(c_custkey * (2 * m + 3) + 31 * {k}) % 97"
        f" + CASE WHEN c_custkey % 4 = {k} THEN 40 ELSE 0 END AS w{k}"
        for k in range(4)
    )
)


def angle(x: str, y: str) -> str:
    return f"CASE WHEN {y} = 0 THEN 0.0 ELSE degrees(atan({x} / nullif({y}, 0))) END"


def speed(e: str, m: str) -> str:
    return (
        f"CASE WHEN {m} > 0 THEN CASE WHEN {e} >= 0 THEN sqrt(abs(2 * {e} / nullif({m}, 0)))"
        " END ELSE 0.0 END"
    )


def time(d: str, v: str) -> str:
    return f"CASE WHEN {v} > 0 THEN abs({d}) / nullif({v}, 0) ELSE 0.0 END"


def rounded(kind: str, text: str) -> str:
    """Means are rounded: their last bits depend on the order of addition."""
    return f"round({text}, 6)" if kind == "mean" else text


PARTICLE_FEATURE = f"""
particle_1 AS (
  SELECT *, abs(particle_category) AS particle_category_abs,
         sqrt(particle_px * particle_px + particle_py * particle_py + particle_pz * particle_pz)
           AS particle_distance,
         sqrt(particle_py * particle_py + particle_pz * particle_pz) AS yz_dis,
         {angle('particle_px', 'particle_py')} AS angle_xy,
         {angle('particle_px', 'particle_pz')} AS angle_xz,
         {speed('particle_energy', 'particle_mass')} AS particle_speed
  FROM particle),
particle_2 AS (
  SELECT *, particle_px / nullif(particle_distance, 0) AS x_div_dist,
         yz_dis / nullif(particle_distance, 0) AS yz_div_dist
  FROM particle_1),
particle_3 AS (
  SELECT *, particle_energy * x_div_dist AS energy_x, particle_mass * x_div_dist AS mass_x,
         particle_mass * yz_div_dist AS mass_yz, particle_speed * x_div_dist AS speed_x
  FROM particle_2),
particle_feature AS (
  SELECT *, {time('particle_px', 'speed_x')} AS time_x FROM particle_3)"""

AXES = {"x": "jet_px", "y": "jet_py", "z": "jet_pz", "xy": "xy_dis", "yz": "yz_dis", "zx": "zx_dis"}
QUANTITIES = {
    "energy": "jet_energy", "mass": "jet_mass", "speed": "jet_speed", "mv": "jet_mv",
    "particle_mv": "particle_mv",
}

JET_FEATURE = f"""
jet_0 AS (
  SELECT * REPLACE (CASE WHEN jet_mass < 0 THEN 0 ELSE jet_mass END AS jet_mass) FROM jet),
jet_1 AS (
  SELECT *, sqrt(jet_px * jet_px + jet_py * jet_py + jet_pz * jet_pz) AS jet_distance,
         sqrt(jet_px * jet_px + jet_py * jet_py) AS xy_dis,
         sqrt(jet_py * jet_py + jet_pz * jet_pz) AS yz_dis,
         sqrt(jet_pz * jet_pz + jet_px * jet_px) AS zx_dis,
         {", ".join(
             f"{angle(f'jet_p{a}', f'jet_p{b}')} AS angle_{a}{b}"
             for a, b in ("xy", "yx", "yz", "zy", "zx", "xz")
         )},
         jet_mass / nullif(number_of_particles_in_this_jet, 0) AS mean_particles_mass,
         jet_energy / nullif(number_of_particles_in_this_jet, 0) AS mean_particles_energy,
         {speed('jet_energy', 'jet_mass')} AS jet_speed
  FROM jet_0),
jet_2 AS (
  SELECT *, {", ".join(f"{c} / nullif(jet_distance, 0) AS {a}_div_dist" for a, c in AXES.items())},
         jet_mass * jet_speed AS jet_mv,
         jet_mass * jet_speed / nullif(number_of_particles_in_this_jet, 0) AS particle_mv,
         {time('jet_distance', 'jet_speed')} AS time_dis
  FROM jet_1),
jet_3 AS (
  SELECT *, {", ".join(
      f"{c} * {a}_div_dist AS {q}_{a}" for q, c in QUANTITIES.items() for a in AXES
  )}
  FROM jet_2),
jet_feature AS (
  SELECT *, {", ".join(f"{time(c, f'speed_{a}')} AS time_{a}" for a, c in AXES.items())}
  FROM jet_3)"""

JET_RAW = [
    "number_of_particles_in_this_jet", "jet_px", "jet_py", "jet_pz", "jet_energy", "jet_mass",
]
JET_DERIVED = (
    ["jet_distance", "xy_dis", "yz_dis", "zx_dis", "jet_speed", "jet_mv", "particle_mv", "time_dis"]
    + [f"angle_{p}" for p in ("xy", "yx", "yz", "zy", "zx", "xz")]
    + ["mean_particles_mass", "mean_particles_energy"]
    + [f"{a}_div_dist" for a in AXES]
    + [f"{q}_{a}" for q in QUANTITIES for a in AXES]
    + [f"time_{a}" for a in AXES]
)

# family -> column of the event statistics
FAMILIES = {"number_particles": "number_of_particles_in_this_jet"}
FAMILIES |= {f"particles_{q}": f"mean_particles_{q}" for q in ("mass", "energy")}
FAMILIES |= {q: f"jet_{q}" for q in ("mass", "energy", "distance", "speed", "mv", "px", "py", "pz")}
FAMILIES |= {
    c: c for c in JET_DERIVED if not c.startswith(("jet_", "mean_"))
}
SQL_STATS = {"max": "max", "mean": "avg", "min": "min", "std": "stddev_samp"}
EVENT_STAT_NAMES = (
    ["event_id_count"]
    + [f"event_id_{f}_{k}" for f in FAMILIES for k in SQL_STATS]
    + ["event_id_energy_sum", "event_id_mass_sum", "event_id_speed"]
)

EVENT_STAT = f"""
event_grouped AS (
  SELECT event_id, count(jet_id) AS event_id_count,
         {", ".join(
             f"{rounded(k, f'{fn}({c})')} AS event_id_{f}_{k}"
             for f, c in FAMILIES.items() for k, fn in SQL_STATS.items()
         )},
         sum(jet_energy) AS event_id_energy_sum, sum(jet_mass) AS event_id_mass_sum
  FROM jet_feature GROUP BY event_id),
event_stat AS (
  SELECT *, {speed('event_id_energy_sum', 'event_id_mass_sum')} AS event_id_speed
  FROM event_grouped)"""

COMPACT_STD = {
    "mass": "particle_mass", "energy": "particle_energy", "mass_x": "mass_x",
    "energy_x": "energy_x", "x_div_dist": "x_div_dist", "speed": "particle_speed",
    "speed_x": "speed_x", "px": "particle_px", "angle_xy": "angle_xy", "angle_xz": "angle_xz",
    "time_x": "time_x",
}
COMPACT_STATS = (
    [f"jet_id_{f}_std" for f in COMPACT_STD]
    + ["jet_id_energy_sum", "jet_id_mass_sum"]
    + ["particle_category_unique_len", "particle_category_unique_len_abs"]
)
JET_STAT = f"""
jet_stat AS (
  SELECT jet_id, {", ".join(f"stddev_samp({c}) AS jet_id_{f}_std" for f, c in COMPACT_STD.items())},
         sum(particle_energy) AS jet_id_energy_sum, sum(particle_mass) AS jet_id_mass_sum,
         CAST(count(DISTINCT particle_category) AS INTEGER) AS particle_category_unique_len,
         CAST(count(DISTINCT abs(particle_category)) AS INTEGER)
           AS particle_category_unique_len_abs
  FROM particle_feature GROUP BY jet_id)"""

BROAD_STATS = {
    f"jet_id_{f}_{k}": rounded(k, f"{SQL_STATS[k]}({c})")
    for f, c, kinds in (
        ("mass_x", "mass_x", ("mean", "min", "std")),
        ("mass_yz", "mass_yz", ("mean", "std")),
        ("energy_x", "energy_x", ("mean", "min", "std")),
        ("speed", "particle_speed", ("mean", "min", "std")),
        ("speed_x", "speed_x", ("mean", "min", "std")),
        ("px", "particle_px", ("mean", "min", "std")),
        ("time_x", "time_x", ("mean", "min", "std")),
    )
    for k in kinds
}
BROAD_STATS |= {"jet_id_energy_sum": "sum(particle_energy)", "jet_id_mass_sum": "sum(particle_mass)"}
BROAD_NAMES = [*BROAD_STATS, "jet_id_speed"]
BROAD_STAT = f"""
broad_grouped AS (
  SELECT jet_id, {", ".join(f"{x} AS {n}" for n, x in BROAD_STATS.items())}
  FROM particle_feature GROUP BY jet_id),
broad_stat AS (
  SELECT *, {speed('jet_id_energy_sum', 'jet_id_mass_sum')} AS jet_id_speed FROM broad_grouped)"""

RANKED = """
ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY jet_id ORDER BY abs(particle_px) DESC, line_number, part_key, supplier_key,
    price, shipped) - 1 AS slot
  FROM particle_feature)"""

COMPACT_SLOTS = [
    "particle_category", "particle_category_abs", "particle_px", "particle_py", "particle_pz",
    "particle_energy", "particle_mass", "x_div_dist", "particle_distance", "particle_speed",
    "speed_x", "energy_x", "mass_x", "time_x", "angle_xy", "angle_xz",
]
BROAD_SLOTS = [
    "particle_category", "particle_px", "particle_py", "particle_pz", "particle_energy",
    "particle_mass", "energy_x", "mass_x", "mass_yz", "particle_speed",
]

DEPENDS = {
    "particle": (PARTICLE, []),
    "jet": (JET, ["particle"]),
    "event": (EVENT, []),
    "prediction": (PREDICTION, []),
    "particle_feature": (PARTICLE_FEATURE, ["particle"]),
    "jet_feature": (JET_FEATURE, ["jet"]),
    "event_stat": (EVENT_STAT, ["jet_feature"]),
    "jet_stat": (JET_STAT, ["particle_feature"]),
    "broad_stat": (BROAD_STAT, ["particle_feature"]),
    "ranked": (RANKED, ["particle_feature"]),
}


def sql(needs: list[str], body: str, extra: str = "") -> str:
    """WITH the named tables and what they depend on, then the body."""
    order: list[str] = []

    def visit(name: str) -> None:
        for other in DEPENDS[name][1]:
            visit(other)
        if name not in order:
            order.append(name)

    for name in needs:
        visit(name)
    parts = [DEPENDS[name][0].strip() for name in order] + ([extra.strip()] if extra else [])
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()


def floats(names: list[str], prefix: str = "") -> str:
    """As float; adding 0 turns -0.0 into 0.0."""
    return ", ".join(f"CAST({prefix}{n} AS FLOAT) + {ZERO} AS {n}" for n in names)


ZERO = "CAST(0 AS FLOAT)"
LABEL = "CAST(label AS DOUBLE) AS label"


def slot_type(name: str) -> str:
    return "INTEGER" if "particle_category" in name else "FLOAT"


def pivoted(names: list[str], k: int, prefix: str, types=slot_type) -> list[tuple[str, str]]:
    """(column, aggregate): child i of a grouped, ranked table, 0 if missing."""
    return [
        (
            f"{prefix}{i}_{n}",
            f"CASE WHEN count(*) > {i} THEN CAST(max(CASE WHEN slot = {i} THEN {n} END)"
            f" AS {types(n)}) + CAST(0 AS {types(n)}) ELSE 0 END",
        )
        for i in range(k)
        for n in names
    ]


def selected(pairs: list[tuple[str, str]]) -> str:
    return ",\n".join(f"{expression} AS {name}" for name, expression in pairs)


PARTICLE_ID = "jet_id, line_number, part_key, supplier_key"
SHARED = [s for s in COMPACT_STATS if s != "jet_id_energy_std"]


def typed(names: list[str], prefix: str = "") -> str:
    return ", ".join(f"CAST({prefix}{n} AS {slot_type(n)}) + CAST(0 AS {slot_type(n)}) AS {n}" for n in names)


def flat_compact(k: int) -> str:
    return f"""
flat AS (
  SELECT jet_id, {selected(pivoted(COMPACT_SLOTS, k, "p"))}
  FROM ranked WHERE slot < {k} GROUP BY jet_id),
flat_particle AS MATERIALIZED (
  SELECT flat.*, {typed(SHARED, "jet_stat.")} FROM flat JOIN jet_stat USING (jet_id))"""


def flat_broad(k: int) -> str:
    repeated = ", ".join(
        f"CASE WHEN kept > {i} THEN CAST({n} AS FLOAT) + {ZERO} ELSE 0 END AS p{i}_{n}"
        for i in range(k)
        for n in BROAD_NAMES
    )
    return f"""
flat AS (
  SELECT jet_id, count(*) AS kept, {selected(pivoted(BROAD_SLOTS, k, "p"))}
  FROM ranked WHERE slot < {k} GROUP BY jet_id),
flat_particle AS MATERIALIZED (
  SELECT flat.* EXCLUDE (kept), {repeated} FROM flat JOIN broad_stat USING (jet_id))"""


def event_table(flat: str, jet_names: list[str], particle_names: list[str], stat: str) -> str:
    def types(name: str) -> str:
        if name == "number_of_particles_in_this_jet":
            return "INTEGER"
        return slot_type(name)

    columns = JET_RAW + JET_DERIVED + jet_names + particle_names
    return sql(
        ["event_stat", stat, "ranked", "event"],
        f"""
SELECT number_of_jet_in_this_event, event_id_count,
       {event_stat_casts()}, wide.*
FROM wide JOIN event_stat USING (event_id) JOIN event USING (event_id)""",
        flat.strip()
        + f""",
jet_ranked AS MATERIALIZED (
  SELECT jet_feature.*, flat_particle.* EXCLUDE (jet_id), row_number() OVER (
    PARTITION BY event_id ORDER BY abs(jet_px) DESC NULLS LAST, jet_feature.jet_id) - 1 AS slot
  FROM jet_feature JOIN flat_particle ON flat_particle.jet_id = jet_feature.jet_id),
wide AS (
  SELECT event_id, CAST(max(CASE WHEN slot = 0 THEN label END) AS DOUBLE) AS label, max(split) AS split,
         {selected(pivoted(columns, 4, "j", types))}
  FROM jet_ranked WHERE slot < 4 GROUP BY event_id)""",
    )


def event_stat_casts() -> str:
    whole = {"event_id_number_particles_max", "event_id_number_particles_min"}
    return ", ".join(
        f"CAST({n} AS INTEGER) AS {n}" if n in whole else floats([n]) for n in EVENT_STAT_NAMES[1:]
    )


def event_stat_floats() -> str:
    whole = {"event_id_number_particles_max", "event_id_number_particles_min"}
    return ", ".join(
        n if n in whole else floats([n]) for n in EVENT_STAT_NAMES[1:]
    )


def top_jets(names: list[str], k: int) -> str:
    """The k leading jets of each event in slots, over all jets."""
    return f"""
jet_ranked AS (
  SELECT *, row_number() OVER (
    PARTITION BY event_id ORDER BY abs(jet_px) DESC NULLS LAST, jet_id) - 1 AS slot FROM jet),
wide AS (
  SELECT event_id, {selected(pivoted(names, k, "j", lambda n: "DOUBLE"))}
  FROM jet_ranked WHERE slot < {k} GROUP BY event_id)"""


def auc(k: int, n: str = "1") -> str:
    """AUC of class k against the rest from predicted classes."""

    def total(condition: str) -> str:
        return f"sum(CASE WHEN {condition} THEN {n} ELSE 0 END)"

    return (
        f"(CAST({total(f'truth = {k} AND winner = {k}')} AS DOUBLE)"
        f" / nullif({total(f'truth = {k}')}, 0)"
        f" + CAST({total(f'truth <> {k} AND winner <> {k}')} AS DOUBLE)"
        f" / nullif({total(f'truth <> {k}')}, 0)) / 2"
    )


def macro(n: str = "1") -> str:
    return "(" + " + ".join(auc(k, n) for k in range(4)) + ") / 4"


SIDE_BY_SIDE = "side AS (SELECT id, " + ", ".join(
    f"max(CASE WHEN m = {m} THEN p{k} END) AS c{m * 4 + k}" for m in range(4) for k in range(4)
) + " FROM prediction GROUP BY id)"

WEIGHTED_CLASSES = ", ".join(
    f"a * c{k} + b * c{4 + k} + c * c{8 + k} + d * c{12 + k} AS s{k}" for k in range(4)
)
FIRST_MAXIMUM = (
    "CASE WHEN s0 >= greatest(s1, s2, s3) THEN 0 WHEN s1 >= greatest(s2, s3) THEN 1"
    " WHEN s2 >= s3 THEN 2 ELSE 3 END"
)

BLEND_SCORES = f"""{SIDE_BY_SIDE},
part AS (SELECT unnest(range(1, 18)) AS w),
grid AS (
  SELECT x.w AS a, y.w AS b, z.w AS c, 20 - x.w - y.w - z.w AS d
  FROM part x, part y, part z WHERE x.w + y.w + z.w < 20),
scored AS (
  SELECT CAST(a AS INTEGER) AS a, CAST(b AS INTEGER) AS b, CAST(c AS INTEGER) AS c,
         CAST(d AS INTEGER) AS d, truth, {FIRST_MAXIMUM} AS winner
  FROM (SELECT a, b, c, d, event_id % 4 AS truth, {WEIGHTED_CLASSES}
        FROM side JOIN event ON id = event_id, grid WHERE label IS NOT NULL)),
blend AS (SELECT a, b, c, d, round({macro()}, 6) AS auc FROM scored GROUP BY a, b, c, d)"""

LABEL_OF = "CASE {0} WHEN 0 THEN 21 WHEN 1 THEN 1 WHEN 2 THEN 4 WHEN 3 THEN 5 END"
CLASS_OF = "CASE {0} WHEN 21 THEN 0 WHEN 1 THEN 1 WHEN 4 THEN 2 WHEN 5 THEN 3 END"

DRIFT_FEATURES = [*JET_RAW, "jet_distance", "jet_speed", "angle_xy"]


def melted(names: list[str], table: str, keep: str = "") -> str:
    return " UNION ALL ".join(
        f"SELECT {keep}'{n}' AS column_name, CAST({n} AS DOUBLE) AS value FROM {table}"
        for n in names
    )


HISTOGRAM = f"""
long AS (SELECT * FROM ({melted(DRIFT_FEATURES, "jet_feature", "split, ")}) WHERE value IS NOT NULL),
edge AS (SELECT column_name, min(value) AS low, max(value) AS high FROM long GROUP BY column_name),
hist AS (
  SELECT column_name,
         CAST(least(floor(coalesce((value - low) / nullif(high - low, 0), 0) * 20), 19) AS INTEGER)
           AS bin,
         sum(CASE WHEN split = 'train' THEN 1 ELSE 0 END) AS train_n,
         sum(CASE WHEN split = 'test' THEN 1 ELSE 0 END) AS test_n
  FROM long JOIN edge USING (column_name) GROUP BY ALL)"""

DRIFT = f"""{HISTOGRAM},
every_bin AS (
  SELECT column_name, b AS bin FROM edge, (SELECT unnest(range(20)) AS b)),
filled AS (
  SELECT column_name, bin, coalesce(train_n, 0) AS train_n, coalesce(test_n, 0) AS test_n
  FROM every_bin LEFT JOIN hist USING (column_name, bin)),
share AS (
  SELECT column_name,
         (train_n + 0.5e0) / (sum(train_n) OVER w + 10) AS p,
         (test_n + 0.5e0) / (sum(test_n) OVER w + 10) AS q,
         abs(sum(train_n) OVER u / CAST(sum(train_n) OVER w AS DOUBLE)
             - sum(test_n) OVER u / CAST(sum(test_n) OVER w AS DOUBLE)) AS gap
  FROM filled
  WINDOW w AS (PARTITION BY column_name),
         u AS (PARTITION BY column_name ORDER BY bin ROWS UNBOUNDED PRECEDING))"""

HASH = "CAST(concat('0x', substr(md5({0}), 1, 8)) AS BIGINT)"
GROUP_FOLD = "CAST(" + HASH.format("CAST({0} AS VARCHAR)") + " % 5 AS INTEGER)"
SEEDED = "md5(concat('{0}:', CAST({1} AS VARCHAR)))"

PARTICLE_INTEGERS = ["jet_id", "particle_category", "line_number", "part_key", "supplier_key"]
PARTICLE_REALS = [f"particle_{n}" for n in ("px", "py", "pz", "energy", "mass")] + ["price"]


def type_table(integers: list[str], reals: list[str], texts: list[str], table: str) -> str:
    """Per column the narrowest type that holds all of its values."""
    widths = " ".join(
        f"WHEN min({{0}}) >= -{1 << bits} AND max({{0}}) < {1 << bits} THEN '{name}'"
        for name, bits in (("tinyint", 7), ("smallint", 15), ("int", 31))
    )
    fits = "WHEN bool_and(CAST(CAST({0} AS FLOAT) AS DOUBLE) = {0}) THEN 'float'"
    found = {n: f"CASE {widths.format(n)} ELSE 'bigint' END" for n in integers}
    found |= {n: f"CASE {fits.format(n)} ELSE 'double' END" for n in reals}
    found |= {n: "max('string')" for n in texts}
    return " UNION ALL ".join(
        f"SELECT '{n}' AS column_name, {kind} AS type_name FROM {table}" for n, kind in found.items()
    )


def merged_stat(kind: str, name: str) -> str:
    """As it is stored: the count as it is, else as float."""
    functions = {**SQL_STATS, "count": "count", "sum": "sum"}
    value = rounded(kind, f"{functions[kind]}({name})")
    return value if kind == "count" else f"CAST({value} AS FLOAT) + {ZERO}"


ORACLES = {
    # features
    "particle_features": sql(
        ["particle_feature"],
        f"""SELECT {PARTICLE_ID}, particle_category, particle_category_abs, {floats(
            COMPACT_SLOTS[2:])} FROM particle_feature""",
    ),
    "particle_features_broad": sql(
        ["particle_feature"],
        f"""SELECT {PARTICLE_ID}, {floats(["particle_distance", "yz_dis", "x_div_dist",
            "yz_div_dist", "energy_x", "mass_x", "mass_yz", "particle_speed", "speed_x",
            "time_x"])} FROM particle_feature""",
    ),
    "jet_features": sql(
        ["jet_feature"],
        f"""SELECT jet_id, event_id, {LABEL}, split, number_of_particles_in_this_jet,
            {floats(JET_RAW[1:] + JET_DERIVED)} FROM jet_feature""",
    ),
    "jet_id_stats": sql(
        ["jet_stat"],
        f"""SELECT {PARTICLE_ID}, {floats(COMPACT_STATS[:-2])}, {", ".join(COMPACT_STATS[-2:])}
            FROM particle JOIN jet_stat USING (jet_id)""",
    ),
    "jet_id_stats_broad": sql(
        ["broad_stat"], f"SELECT jet_id, {floats(BROAD_NAMES)} FROM broad_stat"
    ),
    "jet_id_count": sql(
        ["particle"],
        f"""SELECT {PARTICLE_ID}, CAST(particle_px AS FLOAT) AS particle_px,
            count(particle_px) OVER w AS jet_id_px_count,
            CAST(max(particle_px) OVER w AS FLOAT) AS jet_id_px_max,
            CAST(avg(particle_px) OVER w AS FLOAT) AS jet_id_px_mean,
            CAST(min(particle_px) OVER w AS FLOAT) AS jet_id_px_min,
            CAST(stddev_samp(particle_px) OVER w AS FLOAT) AS jet_id_px_std,
            CAST(sum(particle_px) OVER w AS FLOAT) AS jet_id_px_sum
            FROM particle WINDOW w AS (PARTITION BY jet_id)""",
    ),
    "category_distinct": sql(
        ["particle"],
        """SELECT jet_id, CAST(count(DISTINCT particle_category) AS INTEGER) AS n_signed,
           CAST(count(DISTINCT abs(particle_category)) AS INTEGER) AS n_abs
           FROM particle GROUP BY jet_id""",
    ),
    "distinct_per_key": sql(
        ["particle"],
        """SELECT jet_id, CAST(count(DISTINCT supplier_key) AS INTEGER) AS n_distinct
           FROM particle GROUP BY jet_id""",
    ),
    "event_id_stats": sql(
        ["event_stat"],
        f"""SELECT jet_id, jet_feature.event_id, {LABEL}, split, number_of_particles_in_this_jet,
            {floats(JET_RAW[1:] + JET_DERIVED)}, event_id_count, {event_stat_floats()}
            FROM jet_feature JOIN event_stat ON event_stat.event_id = jet_feature.event_id""",
    ),
    "event_speed": sql(
        ["event_stat"],
        f"""SELECT event_id, event_id_count, {floats(EVENT_STAT_NAMES[-3:])} FROM event_stat""",
    ),
    "topk_particles": sql(
        ["ranked"],
        f"""SELECT {PARTICLE_ID}, particle_px, CAST(slot AS INTEGER) AS slot
            FROM ranked WHERE slot < 4""",
    ),
    "topk_jets": sql(
        ["jet"],
        """SELECT event_id, jet_id, jet_px, CAST(slot AS INTEGER) AS slot
           FROM (SELECT *, row_number() OVER (PARTITION BY event_id
                 ORDER BY abs(jet_px) DESC NULLS LAST, jet_id) - 1 AS slot FROM jet)
           WHERE slot < 4""",
    ),
    "flatten_particles": sql(
        ["jet_stat", "ranked"], "SELECT * FROM flat_particle", flat_compact(20)
    ),
    "flatten_particles_broad": sql(
        ["broad_stat", "ranked"], "SELECT * FROM flat_particle", flat_broad(16)
    ),
    "flatten_jets": sql(
        ["jet"],
        "SELECT event_id, "
        + ", ".join(
            f"CAST(j{i}_{n} AS {'INTEGER' if n == JET_RAW[0] else 'FLOAT'}) AS j{i}_{n}"
            for i in range(4)
            for n in (JET_RAW[0], "jet_px", "jet_energy", "jet_mass")
        )
        + " FROM wide",
        top_jets([JET_RAW[0], "jet_px", "jet_energy", "jet_mass"], 4),
    ),
    "event_table": event_table(
        flat_compact(20), SHARED, [f"p{i}_{n}" for i in range(20) for n in COMPACT_SLOTS], "jet_stat"
    ),
    "event_table_broad": event_table(
        flat_broad(16),
        [],
        [f"p{i}_{n}" for i in range(16) for n in BROAD_SLOTS + BROAD_NAMES],
        "broad_stat",
    ),
    "leading_particles": sql(
        ["jet_stat", "ranked", "jet"],
        """SELECT flat_particle.*, event_id, CAST(jet_energy AS FLOAT) AS jet_energy
           FROM flat_particle JOIN jet ON jet.jet_id = flat_particle.jet_id""",
        flat_compact(4),
    ),
    # files
    "csv_roundtrip": sql(
        ["particle"],
        """SELECT jet_id, particle_category, particle_px, particle_py, particle_pz,
           particle_energy, particle_mass FROM particle""",
    ),
    "csv_column_subset": sql(["jet"], f"SELECT jet_id, event_id, {LABEL} FROM jet"),
    "event_csv_scan": sql(["event"], "SELECT event_id, number_of_jet_in_this_event FROM event"),
    "parquet_roundtrip": sql(
        ["jet"],
        f"SELECT jet_id, event_id, {', '.join(JET_RAW)}, split FROM jet WHERE split = 'test'",
    ),
    "predictions_roundtrip": sql(
        ["prediction"],
        """SELECT id, model, p0 AS p1, p1 AS p2, p2 AS p3, p3 AS p4
           FROM prediction WHERE model IN ('lgb', 'nn') AND split = 'train'""",
    ),
    "probability_csv": sql(
        ["prediction"],
        """SELECT id, p0 AS p1, p1 AS p2, p2 AS p3, p3 AS p4
           FROM prediction WHERE model = 'cat' AND split = 'test'""",
    ),
    "wide_csv": sql(
        ["jet"],
        "SELECT * REPLACE ("
        + ", ".join(f"CAST(j{i}_{JET_RAW[0]} AS INTEGER) AS j{i}_{JET_RAW[0]}" for i in range(4))
        + ") FROM wide",
        top_jets(JET_RAW, 4),
    ),
    "submission_csv": sql(
        ["prediction", "jet"],
        f"""SELECT jet_id AS id, {LABEL_OF.format("winner")} AS label
            FROM jet JOIN prediction ON id = event_id
            WHERE model = 'lgb' AND jet.split = 'test'""",
    ),
    "sample_fill": sql(
        ["prediction", "event"],
        f"""SELECT event_id AS id, CAST({LABEL_OF.format("winner")} AS DOUBLE) AS label
            FROM event LEFT JOIN (SELECT * FROM prediction WHERE model = 'xgb' AND split = 'test')
            ON id = event_id""",
    ),
    "predictions_every_model": sql(
        ["prediction"],
        "SELECT id, model, split, p0 AS p1, p1 AS p2, p2 AS p3, p3 AS p4 FROM prediction",
    ),
    "csv_types": sql(["particle"], type_table(PARTICLE_INTEGERS, PARTICLE_REALS, ["shipped"], "particle")),
    "csv_inferred": sql(
        ["particle"],
        "SELECT "
        + ", ".join(f"CAST({n} AS BIGINT) AS {n}" for n in PARTICLE_INTEGERS)
        + f""", {", ".join(PARTICLE_REALS)}, CAST(CAST(shipped AS DATE) AS VARCHAR) AS shipped
            FROM particle""",
    ),
    "narrowest_types": sql(
        ["jet"],
        type_table(
            ["jet_id", "event_id", JET_RAW[0], "label"],
            [*JET_RAW[1:], "third"],
            ["split"],
            "(SELECT *, jet_energy / 3 AS third FROM jet)",
        ),
    ),
    "bucketed_join": sql(
        ["particle", "jet"],
        """SELECT jet_id, event_id, jet_energy, coalesce(n_particles, 0) AS n_particles, most_energy
           FROM jet LEFT JOIN (
             SELECT jet_id, count(*) AS n_particles, max(particle_energy) AS most_energy
             FROM particle GROUP BY jet_id) USING (jet_id)""",
    ),
    # columns
    "select_exclude": sql(["jet"], f"SELECT jet_id, {', '.join(JET_RAW)} FROM jet"),
    "select_prefix": sql(
        ["jet"],
        """SELECT jet_id,
           max(number_of_particles_in_this_jet) OVER w AS event_id_number_particles_max,
           min(number_of_particles_in_this_jet) OVER w AS event_id_number_particles_min
           FROM jet WINDOW w AS (PARTITION BY event_id)""",
    ),
    "select_regex": sql(
        ["jet"],
        "SELECT event_id, "
        + ", ".join(f"j{i}_jet_p{a}" for i in range(3) for a in "xyz")
        + " FROM wide",
        top_jets(JET_RAW, 3),
    ),
    "reindex_columns": sql(
        ["jet"], "SELECT jet_px, jet_id, CAST(NULL AS DOUBLE) AS not_there, event_id FROM jet"
    ),
    "drop_columns": sql(
        ["jet"],
        """SELECT event_id, number_of_particles_in_this_jet, jet_px, jet_py, jet_pz, jet_energy,
           jet_id FROM jet""",
    ),
    "rename_slots": sql(
        ["prediction"],
        "SELECT id, p0 AS c4, p1 AS c5, p2 AS c6, p3 AS c7 FROM prediction WHERE model = 'xgb'",
    ),
    "narrow_cast": sql(
        ["particle"],
        f"""SELECT jet_id, part_key, supplier_key,
            particle_category,
            {floats(["particle_px", "particle_py", "particle_pz", "particle_energy",
                     "particle_mass"])},
            jet_id * 4 AS too_wide FROM particle""",
    ),
    "cast_slots": sql(
        ["ranked"],
        "SELECT jet_id, "
        + selected(pivoted(["particle_category"], 6, "p"))
        + " FROM ranked WHERE slot < 6 GROUP BY jet_id",
    ),
    "fill_null": sql(
        ["jet"],
        "SELECT jet_id, "
        + ", ".join(f"coalesce({n}, 0) AS {n}" for n in [*JET_RAW, "label"])
        + " FROM jet",
    ),
    "keep_one_label": sql(
        ["jet"],
        "SELECT event_id, CAST(j0_label AS DOUBLE) AS label, "
        + ", ".join(f"j{i}_jet_energy" for i in range(4))
        + " FROM wide",
        top_jets(["label", "jet_energy"], 4),
    ),
    # rows
    "train_test_union": sql(["jet"], f"SELECT jet_id, event_id, jet_energy, {LABEL}, split FROM jet"),
    "train_slice": sql(
        ["jet_feature"],
        """SELECT jet_id, CAST(jet_speed AS FLOAT) AS jet_speed, label
           FROM jet_feature WHERE split = 'train'""",
    ),
    "drift_union": sql(
        ["jet"],
        f"""SELECT jet_id, {', '.join(JET_RAW)},
            CASE WHEN split = 'test' THEN 1 ELSE 0 END AS target FROM jet""",
    ),
    "distinct_event_keys": "SELECT DISTINCT o_custkey AS event_id FROM orders",
    "profile": sql(
        ["jet"],
        " UNION ALL ".join(
            f"""SELECT {i} AS position, '{n}' AS column_name, '{t}' AS dtype, count(*) AS n_rows,
                count({n}) AS n_present FROM jet"""
            for i, (n, t) in enumerate(
                [("jet_id", "bigint"), ("event_id", "bigint"), (JET_RAW[0], "int")]
                + [(n, "double") for n in JET_RAW[1:]]
                + [("label", "int"), ("split", "string")]
            )
        ),
    ),
    "label_agreement": sql(
        ["jet"],
        """SELECT event_id, count(DISTINCT label) AS n_values, count(DISTINCT label) <= 1 AS agrees
           FROM jet GROUP BY event_id""",
    ),
    "status_agreement": sql(
        ["particle"],
        """SELECT supplier_key, count(DISTINCT particle_category) AS n_values,
                  count(DISTINCT particle_category) <= 1 AS agrees
           FROM particle GROUP BY supplier_key""",
    ),
    "merged_group_stats": sql(
        ["jet"],
        f"SELECT {JET_RAW[0]}, "
        + ", ".join(
            f"{merged_stat(kind, n)} AS {JET_RAW[0]}_{n.removeprefix('jet_')}_{kind}"
            for n in JET_RAW[1:]
            for kind in ("count", "max", "mean", "min", "std", "sum")
        )
        + f" FROM jet GROUP BY {JET_RAW[0]}",
    ),
    "describe_columns": sql(
        ["jet"],
        f"""SELECT column_name, count(value) AS count, CAST(avg(value) AS FLOAT) AS mean,
            CAST(stddev_samp(value) AS FLOAT) AS std, CAST(min(value) AS FLOAT) AS min,
            CAST(quantile_cont(value, 0.25) AS FLOAT) AS q25,
            CAST(quantile_cont(value, 0.5) AS FLOAT) AS q50,
            CAST(quantile_cont(value, 0.75) AS FLOAT) AS q75, CAST(max(value) AS FLOAT) AS max
            FROM ({melted(JET_RAW, "jet")}) GROUP BY column_name""",
    ),
    "importance_share": sql(
        ["jet"],
        f"""SELECT feature, gain, round(100.0e0 * gain / sum(gain) OVER (), 6) AS share
            FROM (SELECT column_name AS feature, count(CASE WHEN value > 0 THEN 1 END) AS gain
                  FROM ({melted(JET_RAW, "jet")}) GROUP BY column_name)
            QUALIFY gain > 0 ORDER BY gain DESC, feature LIMIT 5""",
    ),
    # labels
    "label_map": sql(
        ["event"],
        f"""SELECT event_id, {LABEL}, CAST({CLASS_OF.format("label")} AS DOUBLE) AS class,
            CAST(label AS DOUBLE) AS back,
            CAST({CLASS_OF.format("number_of_jet_in_this_event")} AS DOUBLE) AS partial
            FROM event""",
    ),
    "argmax_class": sql(["prediction"], "SELECT id, model, winner AS class FROM prediction"),
    "one_hot_labels": sql(
        ["event"],
        "SELECT event_id, "
        + ", ".join(
            f"CASE WHEN label = {code} THEN 1 ELSE 0 END AS is_{k}"
            for k, code in enumerate((21, 1, 4, 5))
        )
        + " FROM event",
    ),
    "label_fanout": sql(
        ["prediction", "jet"],
        f"""SELECT jet_id AS id, {LABEL_OF.format("winner")} AS label
            FROM jet JOIN prediction ON id = event_id WHERE model = 'lgb'""",
    ),
    "event_vote": sql(
        ["jet"],
        """SELECT jet_id, event_id, first_value(guess) OVER (
             PARTITION BY event_id ORDER BY votes DESC, guess) AS label
           FROM voted""",
        f"""guessed AS (
              SELECT jet_id, event_id,
                     {LABEL_OF.format("number_of_particles_in_this_jet % 4")} AS guess FROM jet),
            voted AS (
              SELECT *, count(*) OVER (PARTITION BY event_id, guess) AS votes FROM guessed)""",
    ),
    "own_vote": sql(
        ["jet"],
        f"""SELECT event_id, label FROM (
              SELECT event_id, {LABEL_OF.format("number_of_particles_in_this_jet % 4")} AS label,
                     count(*) AS votes FROM jet GROUP BY ALL)
            QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY votes DESC, label) = 1""",
    ),
    "own_deviation": sql(
        ["jet"],
        "SELECT event_id, round(stddev_samp(jet_energy), 3) AS deviation FROM jet GROUP BY event_id",
    ),
    "own_row_value": sql(
        ["jet"],
        """SELECT jet_id, round(jet_pz / nullif(sqrt(jet_px * jet_px + jet_py * jet_py), 0), 6)
           AS steepness FROM jet""",
    ),
    # folds
    "fold_group_hash": sql(
        ["jet"], f"SELECT jet_id, event_id, {GROUP_FOLD.format('event_id')} AS fold FROM jet"
    ),
    "fold_group_balanced": sql(
        ["jet"],
        """SELECT jet_id, event_id, fold FROM jet JOIN dealt USING (event_id)""",
        f"""sized AS (SELECT event_id, count(*) AS size FROM jet GROUP BY event_id),
            placed AS (
              SELECT event_id, (row_number() OVER (
                PARTITION BY size ORDER BY {SEEDED.format('fold', 'event_id')}, event_id) - 1) % 10
                AS step FROM sized),
            dealt AS (
              SELECT event_id, CAST(CASE WHEN step < 5 THEN step ELSE 9 - step END AS INTEGER)
                AS fold FROM placed)""",
    ),
    "fold_stratified": sql(
        ["event"],
        f"""SELECT event_id, {LABEL}, CAST((row_number() OVER (
              PARTITION BY label ORDER BY {SEEDED.format(42, 'event_id')}, event_id) - 1) % 5
              AS INTEGER) AS fold FROM event""",
    ),
    "holdout_split": f"""SELECT o_orderkey AS jet_id, CAST(concat('0x', substr({SEEDED.format(
        42, 'o_orderkey')}, 1, 8)) AS BIGINT) < {int(0.33 * (1 << 32))} AS held_out FROM orders""",
    "fold_training_rows": sql(
        ["jet"],
        """SELECT * FROM (SELECT jet_id, jet_energy, """
        + GROUP_FOLD.format("event_id")
        + " AS fold FROM jet) WHERE fold <> 0",
    ),
    # metrics
    "auc_hard_labels": sql(
        ["prediction"],
        "SELECT model, "
        + ", ".join(f"round({auc(k)}, 6) AS auc_{k}" for k in range(4))
        + f", round({macro()}, 6) AS auc FROM prediction WHERE split = 'train' GROUP BY model",
    ),
    "auc_per_fold": sql(
        ["prediction"],
        f"""SELECT {GROUP_FOLD.format('id')} AS fold, round({macro()}, 6) AS auc FROM prediction
            WHERE split = 'train' AND model = 'lgb' GROUP BY ALL""",
    ),
    "auc_per_model_and_fold": sql(
        ["prediction"],
        f"""SELECT model, {GROUP_FOLD.format('id')} AS fold, round({macro()}, 6) AS auc
            FROM prediction WHERE split = 'train' GROUP BY ALL""",
    ),
    "auc_scores": sql(
        ["prediction"],
        """SELECT class, round((sum(CASE WHEN hit THEN mid_rank ELSE 0 END)
             - CAST(count_if(hit) AS DOUBLE) * (count_if(hit) + 1) / 2)
             / (CAST(count_if(hit) AS DOUBLE) * count_if(NOT hit)), 6) AS auc
           FROM ranked_score GROUP BY class""",
        """score AS ("""
        + " UNION ALL ".join(
            f"""SELECT {k} AS class, p{k} AS score, truth = {k} AS hit FROM prediction
                WHERE split = 'train' AND model = 'lgb'"""
            for k in range(4)
        )
        + """),
           ranked_score AS (
             SELECT class, hit, rank() OVER (PARTITION BY class ORDER BY score)
               + (count(*) OVER (PARTITION BY class, score) - 1) / 2.0e0 AS mid_rank
             FROM score)""",
    ),
    # ensembles
    "stack_matrix": sql(
        ["prediction"], f"SELECT id, {floats([f'c{i}' for i in range(16)])} FROM side", SIDE_BY_SIDE
    ),
    "blend_grid": sql(["prediction", "event"], "SELECT * FROM blend", BLEND_SCORES),
    "blend_best": sql(
        ["prediction", "event"],
        "SELECT * FROM blend ORDER BY auc DESC, a, b, c, d LIMIT 1",
        BLEND_SCORES,
    ),
    "blend_fixed": sql(
        ["prediction"],
        f"""SELECT id, {LABEL_OF.format(FIRST_MAXIMUM.join("()"))} AS label
            FROM (SELECT id, {WEIGHTED_CLASSES} FROM side, (
              SELECT 0.4e0 AS a, 0.25e0 AS b, 0.15e0 AS c, 0.2e0 AS d))""",
        SIDE_BY_SIDE.replace("FROM prediction", "FROM prediction WHERE split = 'test'"),
    ),
    "fold_average": sql(
        ["prediction"],
        "SELECT id, "
        + ", ".join(f"CAST(avg(p{k}) AS FLOAT) AS p{k + 1}" for k in range(4))
        + " FROM prediction GROUP BY id",
    ),
    "model_correlation": sql(
        ["prediction"],
        """SELECT x.model AS "left", y.model AS "right",
           round(corr(x.winner, y.winner), 6) AS correlation
           FROM prediction x JOIN prediction y ON x.id = y.id GROUP BY x.model, y.model""",
    ),
    "standard_scale": sql(
        ["jet"],
        "SELECT jet_id, "
        + ", ".join(f"CAST(({n} - m_{n}) / s_{n} AS FLOAT) AS {n}" for n in JET_RAW)
        + " FROM jet, (SELECT "
        + ", ".join(f"avg({n}) AS m_{n}, stddev_pop({n}) AS s_{n}" for n in JET_RAW)
        + " FROM jet WHERE split = 'train')",
    ),
    # drift
    "drift_histogram": sql(
        ["jet_feature"],
        """SELECT column_name, bin, CAST(train_n AS BIGINT) AS train_n,
           CAST(test_n AS BIGINT) AS test_n FROM hist""",
        HISTOGRAM,
    ),
    "drift_summary": sql(
        ["jet_feature"],
        """SELECT column_name, round(sum((p - q) * ln(p / q)), 6) AS psi,
           round(max(gap), 6) AS ks FROM share GROUP BY column_name""",
        DRIFT,
    ),
}
