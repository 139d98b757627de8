"""Cover program on the driver tables.

Mapping: one plot per part.  The integer terrain columns, the four
wilderness indicators and the forty soil indicators are derived from the
part key, size and brand by fixed rules; ``p_partkey % 5 = 0`` is the
test split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import encode, project
from ..operators.pairs import column_arithmetic, to_sql
from .common import R, T, finish, query, rnd

H, V = "Horizontal_Distance_To_Hydrology", "Vertical_Distance_To_Hydrology"
RD, FP = "Horizontal_Distance_To_Roadways", "Horizontal_Distance_To_Fire_Points"
H9, HN, H3 = "Hillshade_9am", "Hillshade_Noon", "Hillshade_3pm"
SOILS = [f"Soil_Type{i}" for i in range(1, 41)]
AREAS = [f"Wilderness_Area{i}" for i in range(1, 5)]
# The columns the cover script leaves out of the features.
EXCLUDED = ["Cover_Type", "Id", "Soil_Type7", "Soil_Type8", "Soil_Type9", "Soil_Type15",
            "Soil_Type21", "Soil_Type25", "Soil_Type27", "Soil_Type28", "Soil_Type34", "Soil_Type36"]
# Augmentation id shift and offset ranges (low inclusive, high exclusive).
ID_SHIFT = 15120
OFFSET_RANGES = {H: (-10, 10), "Elevation": (-50, 50), RD: (-10, 10)}
COPIES, SEED = 3, 2024

COVER_SQL = (
    "cover AS (SELECT p_partkey AS Id, CAST(floor(p_retailprice) AS INTEGER) + 1000 AS Elevation, "
    "CAST(p_partkey % 360 AS INTEGER) AS Aspect, p_size AS Slope, "
    f"CAST(p_partkey % 500 AS INTEGER) AS {H}, CAST(p_partkey % 200 AS INTEGER) - 50 AS {V}, "
    f"CAST((p_partkey * 7) % 3000 AS INTEGER) AS {RD}, CAST((p_partkey * 13) % 2500 AS INTEGER) AS {FP}, "
    f"CAST(p_partkey % 256 AS INTEGER) AS {H9}, CAST((p_partkey * 3) % 256 AS INTEGER) AS {HN}, "
    f"CAST((p_partkey * 5) % 256 AS INTEGER) AS {H3}, "
    + ", ".join(f"CAST(p_partkey % 4 = {i - 1} AS INTEGER) AS Wilderness_Area{i}" for i in range(1, 5)) + ", "
    + ", ".join(f"CAST(p_size = {i} AS INTEGER) AS Soil_Type{i}" for i in range(1, 41)) + ", "
    "CAST(p_partkey % 7 + 1 AS INTEGER) AS Cover_Type, p_partkey % 5 = 0 AS is_test FROM part), "
    "ctrain AS (SELECT * EXCLUDE (is_test) FROM cover WHERE NOT is_test)")


def cover(t) -> DataFrame:
    k = F.col("p_partkey")
    cols = [k.alias("Id"), (F.floor("p_retailprice").cast("int") + 1000).alias("Elevation"),
            (k % 360).cast("int").alias("Aspect"), F.col("p_size").alias("Slope"),
            (k % 500).cast("int").alias(H), ((k % 200).cast("int") - 50).alias(V),
            ((k * 7) % 3000).cast("int").alias(RD), ((k * 13) % 2500).cast("int").alias(FP),
            (k % 256).cast("int").alias(H9), ((k * 3) % 256).cast("int").alias(HN),
            ((k * 5) % 256).cast("int").alias(H3)]
    cols += [(k % 4 == i - 1).cast("int").alias(f"Wilderness_Area{i}") for i in range(1, 5)]
    cols += [(F.col("p_size") == i).cast("int").alias(f"Soil_Type{i}") for i in range(1, 41)]
    cols += [(k % 7 + 1).cast("int").alias("Cover_Type"), (k % 5 == 0).alias("is_test")]
    return t.part.select(*cols)


def train_split(t) -> DataFrame:
    return cover(t).where(~F.col("is_test")).drop("is_test")


# The names of the derived columns and what they are made of.
SOIL_SUMS = [
    ("Soil_Type12_32", "sum", ("Soil_Type32", "Soil_Type12")),
    ("Soil_Type23_22_32_33", "sum", ("Soil_Type23", "Soil_Type22", "Soil_Type32", "Soil_Type33")),
]
DISTANCES = [
    ("HF1", "sum", (H, FP)), ("HF2", "absolute difference", (H, FP)),
    ("HR1", "absolute sum", (H, RD)), ("HR2", "absolute difference", (H, RD)),
    ("FR1", "absolute sum", (FP, RD)), ("FR2", "absolute difference", (FP, RD)),
    ("slope_hyd", "norm", (H, V)),
    ("Mean_Amenities", "mean", (FP, H, RD)), ("Mean_Fire_Hyd1", "mean", (FP, H)), ("Mean_Fire_Hyd2", "mean", (FP, RD)),
    ("Neg_HorizontalHydrology_HorizontalFire", "difference", (H, FP)),
    ("Neg_HorizontalHydrology_HorizontalRoadways", "difference", (H, RD)),
    ("Neg_HorizontalFire_Points_HorizontalRoadways", "difference", (FP, RD)),
    ("MeanNeg_Mean_HorizontalHydrology_HorizontalFire", "half difference", (H, FP)),
    ("MeanNeg_HorizontalHydrology_HorizontalRoadways", "half difference", (H, RD)),
    ("MeanNeg_HorizontalFire_Points_HorizontalRoadways", "half difference", (FP, RD)),
]
SHADES = [
    ("Hillshade_mean", "mean", (H9, HN, H3)),
    ("Shadiness_morn_noon", "ratio to next", (H9, HN)), ("Shadiness_noon_3pm", "ratio to next", (HN, H3)),
    ("Shadiness_morn_3", "ratio to next", (H9, H3)),
    ("Shadiness_morn_avg", "mean", (H9, HN)), ("Shadiness_afternoon", "mean", (HN, H3)),
    ("Hillshade-9_Noon_diff", "difference", (H9, HN)), ("Hillshade-noon_3pm_diff", "difference", (HN, H3)),
    ("Hillshade-9am_3pm_diff", "difference", (H9, H3)),
]
HEIGHTS = [("Elevation_Vertical", "sum", ("Elevation", V)), ("Neg_Elevation_Vertical", "difference", ("Elevation", V))]
SPECS = [*SOIL_SUMS, *DISTANCES, *SHADES, *HEIGHTS]
LOGGED_SPECS = [("Slope*Elevation", "product", ("Slope", "Elevation"))]     # with the logged elevation
HYDROLOGY_WEIGHT = 0.2


def cover_features(df: DataFrame) -> DataFrame:
    """the derived columns of the fixed tables, first
    over the raw columns, then those that take the logged elevation."""
    df = column_arithmetic(df, SPECS, {"Elevation": F.log1p("Elevation"), V: F.abs(V)})
    df = column_arithmetic(df, LOGGED_SPECS)
    return df.withColumn("Neg_Elev_Hyd", F.col("Elevation") - F.col(H) * HYDROLOGY_WEIGHT)


FEAT_SQL = f"""{COVER_SQL},
f1 AS (SELECT * REPLACE (ln(1 + Elevation) AS Elevation, abs({V}) AS {V}), {to_sql(SPECS)} FROM ctrain),
f3 AS (SELECT *, {to_sql(LOGGED_SPECS)},
         Elevation - {H} * CAST({HYDROLOGY_WEIGHT} AS DOUBLE) AS Neg_Elev_Hyd FROM f1)"""

PAIR_COLS = ["HF1", "HF2", "HR1", "HR2", "FR1", "FR2", "Elevation_Vertical", "Neg_Elevation_Vertical",
             "Mean_Amenities", "Mean_Fire_Hyd1", "Mean_Fire_Hyd2", "Hillshade_mean", "Shadiness_morn_noon",
             "Shadiness_noon_3pm", "Shadiness_morn_3", "Shadiness_morn_avg", "Shadiness_afternoon",
             "Hillshade-9_Noon_diff", "Hillshade-noon_3pm_diff", "Hillshade-9am_3pm_diff",
             "Neg_HorizontalHydrology_HorizontalFire", "Neg_HorizontalHydrology_HorizontalRoadways",
             "Neg_HorizontalFire_Points_HorizontalRoadways", "MeanNeg_Mean_HorizontalHydrology_HorizontalFire",
             "MeanNeg_HorizontalHydrology_HorizontalRoadways", "MeanNeg_HorizontalFire_Points_HorizontalRoadways",
             V]


def _q(c: str) -> str:
    return f'"{c}"'


@query("F06_pair_arithmetic", f"WITH {FEAT_SQL} SELECT Id, "
       + ", ".join(f"{R(_q(c))} AS {_q(c)}" for c in PAIR_COLS) + " FROM f3")
def f06_pair_arithmetic(spark, sf_dir):
    df = cover_features(train_split(T(spark, sf_dir)))
    return finish(df.select("Id", *[F.col(f"`{c}`").cast("double").alias(c) for c in PAIR_COLS]))


@query("F08_euclid", f"WITH {FEAT_SQL} SELECT Id, {R('slope_hyd')} AS slope_hyd FROM f3")
def f08_euclid(spark, sf_dir):
    return finish(cover_features(train_split(T(spark, sf_dir))).select("Id", "slope_hyd"))


@query("F18_indicator_sum", f"WITH {FEAT_SQL} SELECT Id, Soil_Type12_32, Soil_Type23_22_32_33 FROM f3")
def f18_indicator_sum(spark, sf_dir):
    return cover_features(train_split(T(spark, sf_dir))).select("Id", "Soil_Type12_32", "Soil_Type23_22_32_33")


@query("F19_product_logged", f"""WITH {FEAT_SQL}
SELECT Id, {R('Elevation')} AS Elevation, {R('"Slope*Elevation"')} AS "Slope*Elevation",
       {R('Neg_Elev_Hyd')} AS Neg_Elev_Hyd FROM f3""")
def f19_product_logged(spark, sf_dir):
    df = cover_features(train_split(T(spark, sf_dir)))
    return finish(df.select("Id", "Elevation", "`Slope*Elevation`", "Neg_Elev_Hyd"))


@query("E04_reverse_one_hot", f"""WITH {COVER_SQL}
SELECT Id, {' + '.join(f'{i} * Soil_Type{i}' for i in range(1, 41))} AS soil_type,
       {' + '.join(f'{i} * Wilderness_Area{i}' for i in range(1, 5))} AS warea FROM cover""")
def e04_reverse_one_hot(spark, sf_dir):
    return cover(T(spark, sf_dir)).select("Id", encode.reverse_one_hot("Soil_Type", 40).alias("soil_type"),
                                          encode.reverse_one_hot("Wilderness_Area", 4).alias("warea"))


OFFSETS = encode.draw_offsets(COPIES, OFFSET_RANGES, SEED)


def _e07_sql():
    parts = [f"SELECT Id, Elevation, {H}, {RD}, Cover_Type FROM ctrain"]
    for o in OFFSETS:
        parts.append(f"SELECT Id + {ID_SHIFT}, Elevation + ({o['Elevation']}), {H} + ({o[H]}), "
                     f"{RD} + ({o[RD]}), Cover_Type FROM ctrain")
    return f"WITH {COVER_SQL} " + " UNION ALL ".join(parts)


@query("E07_noisy_copies", _e07_sql())
def e07_noisy_copies(spark, sf_dir):
    df = train_split(T(spark, sf_dir)).select("Id", "Elevation", H, RD, "Cover_Type")
    return encode.noisy_copies(df, "Id", ID_SHIFT, OFFSETS)


@query("P01_project_label", f"WITH {COVER_SQL} SELECT Id, Cover_Type FROM ctrain")
def p01_project_label(spark, sf_dir):
    return train_split(T(spark, sf_dir)).select("Id", "Cover_Type")


def feature_columns(df: DataFrame) -> list[str]:
    """Every column not on the exclusion list, in frame order."""
    return project.without(df, EXCLUDED).columns


@query("P02_schema_projection", f"WITH {COVER_SQL} SELECT * EXCLUDE ({', '.join(EXCLUDED)}) FROM ctrain")
def p02_schema_projection(spark, sf_dir):
    return project.without(train_split(T(spark, sf_dir)), EXCLUDED)


@query("P02_projection_by_position", f"""WITH {COVER_SQL}
SELECT Id, Elevation, Aspect, Slope, {H}, {V}, {RD}, {FP}, {H9}, {HN}, {H3} FROM ctrain""")
def p02_projection_by_position(spark, sf_dir):
    return project.by_position(train_split(T(spark, sf_dir)), 0, 11)


@query("D05_table_profile", f"""WITH {COVER_SQL}
SELECT 'rows' AS item, count(*) AS value FROM ctrain
UNION ALL SELECT 'columns', count(*) FROM (DESCRIBE SELECT * FROM ctrain)
UNION ALL SELECT 'type:' || CASE column_type WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint'
                                             WHEN 'DOUBLE' THEN 'double' ELSE lower(column_type) END, count(*)
          FROM (DESCRIBE SELECT * FROM ctrain) GROUP BY 1""")
def d05_table_profile(spark, sf_dir):
    from ..operators.profile import table_profile
    return table_profile(train_split(T(spark, sf_dir)))


# --- correlation-ranked top features (O04 on a deterministic importance) --------------------------
CORR_COLS = ["Elevation", "Aspect", "Slope", H, V, RD, H9, HN, H3, FP]


@query("D06_corr_matrix", f"""WITH {COVER_SQL}
SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, {R(f'CASE WHEN var_pop({a}) = 0 OR var_pop({b}) = 0 THEN NULL ELSE corr({a}, {b}) END')} AS corr FROM ctrain"
    for i, a in enumerate(CORR_COLS + ["Cover_Type"]) for b in (CORR_COLS + ["Cover_Type"])[i + 1:]) + ")")
def d06_corr_matrix(spark, sf_dir):
    from ..operators.profile import corr_matrix
    return finish(corr_matrix(train_split(T(spark, sf_dir)), CORR_COLS + ["Cover_Type"]))


@query("O04_top_k_by_corr", f"""WITH {COVER_SQL},
c AS (SELECT * FROM (""" + " UNION ALL ".join(
    f"SELECT '{a}' AS feature, {R(f'abs(corr({a}, Cover_Type))')} AS importance FROM ctrain" for a in CORR_COLS) + """)),
top AS (SELECT * FROM c ORDER BY importance DESC, feature LIMIT 5)
SELECT feature, importance, """ + R("sum(importance) OVER ()") + " AS share FROM top")
def o04_top_k_by_corr(spark, sf_dir):
    from ..operators.profile import top_k_share
    from ..operators.select import corr_with_target
    imp = corr_with_target(train_split(T(spark, sf_dir)), "Cover_Type", CORR_COLS)
    # rank on the rounded value so near-ties cut the same way everywhere
    imp = imp.select("feature", rnd(F.abs("corr")).alias("importance"))
    return finish(top_k_share(imp, "importance", 5, tie="feature"))
