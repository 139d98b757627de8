"""Passenger program on the driver tables (E3 in SURVEY §3).

Mapping: one passenger per customer; class, sex, age, family counts,
fare, port and outcome are derived by fixed rules from the customer row,
with missing ages, fares and ports injected by key; ``c_custkey % 5 = 0``
is the test split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.contract import flag
from ..functions.scalar import child_or, guarded_log
from ..operators import clean, encode, metrics, profile, project
from .common import R, T, finish, query

PASS_SQL = """
pass AS (
  SELECT c_custkey AS PassengerId,
         CAST(c_nationkey % 3 + 1 AS INTEGER) AS Pclass,
         c_name || ', "' || c_mktsegment || '"' AS Name,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS Sex,
         CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE CAST(c_custkey % 80 AS DOUBLE) + 0.5 END AS Age,
         CAST(c_nationkey % 4 AS INTEGER) AS SibSp,
         CAST(c_custkey % 3 AS INTEGER) AS Parch,
         CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_acctbal END AS Fare,
         CASE c_mktsegment WHEN 'BUILDING' THEN 'S' WHEN 'AUTOMOBILE' THEN 'C'
                           WHEN 'MACHINERY' THEN 'Q' WHEN 'FURNITURE' THEN 'S' END AS Embarked,
         CAST(c_acctbal + (c_custkey * 7919 % 10007) / 2 > 6500 AS INTEGER) AS Survived,
         c_custkey % 5 = 0 AS is_test
  FROM customer),
ptrain AS (SELECT * EXCLUDE (is_test) FROM pass WHERE NOT is_test),
ptest AS (SELECT * EXCLUDE (is_test, Survived) FROM pass WHERE is_test)"""


def passengers(t) -> DataFrame:
    k = F.col("c_custkey")
    seg = F.col("c_mktsegment")
    return t.customer.select(
        k.alias("PassengerId"),
        (F.col("c_nationkey") % 3 + 1).cast("int").alias("Pclass"),
        F.concat(F.col("c_name"), F.lit(', "'), seg, F.lit('"')).alias("Name"),
        F.when(k % 2 == 0, F.lit("male")).otherwise(F.lit("female")).alias("Sex"),
        F.when(k % 7 == 0, F.lit(None)).otherwise((k % 80).cast("double") + 0.5).alias("Age"),
        (F.col("c_nationkey") % 4).cast("int").alias("SibSp"),
        (k % 3).cast("int").alias("Parch"),
        F.when(k % 11 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("Fare"),
        F.when(seg == "BUILDING", "S").when(seg == "AUTOMOBILE", "C").when(seg == "MACHINERY", "Q")
        .when(seg == "FURNITURE", "S").alias("Embarked"),
        (F.col("c_acctbal") + k * 7919 % 10007 / 2 > 6500).cast("int").alias("Survived"),
        (k % 5 == 0).alias("is_test"))


def splits(t) -> tuple[DataFrame, DataFrame]:
    p = passengers(t)
    return p.where(~F.col("is_test")).drop("is_test"), p.where(F.col("is_test")).drop("is_test", "Survived")


def prepare(df: DataFrame) -> DataFrame:
    """The passenger cleaning and derivations, per split (own statistics)."""
    df = clean.fill_constant(df, {"Embarked": "S"})
    df = clean.fill_stats(df, median=["Age"], mean=["Fare"])
    df = df.withColumn("Family", F.col("SibSp") + F.col("Parch") + 1)
    df = clean.assign_where(df, "isAlone", 1, F.col("Family") == 1, 0)   # inverted, as in the program
    df = df.withColumn("Fare", guarded_log("Fare"))
    return df.withColumn("Person", child_or("Age", "Sex"))


SELECTED = ["Pclass", "Person", "Embarked", "Family", "Fare", "isAlone"]

PREP_SQL = f"""{PASS_SQL},
tr_fill AS (SELECT * REPLACE (coalesce(Embarked, 'S') AS Embarked,
                              coalesce(Age, (SELECT median(Age) FROM ptrain)) AS Age,
                              coalesce(Fare, (SELECT avg(Fare) FROM ptrain)) AS Fare) FROM ptrain),
te_fill AS (SELECT * REPLACE (coalesce(Embarked, 'S') AS Embarked,
                              coalesce(Age, (SELECT median(Age) FROM ptest)) AS Age,
                              coalesce(Fare, (SELECT avg(Fare) FROM ptest)) AS Fare) FROM ptest),
tr_prep AS (SELECT * REPLACE (CASE WHEN Fare > 0 THEN ln(Fare) ELSE 0 END AS Fare),
                   SibSp + Parch + 1 AS Family, CASE WHEN SibSp + Parch + 1 = 1 THEN 0 ELSE 1 END AS isAlone,
                   CASE WHEN Age < 10 THEN 'child' ELSE Sex END AS Person FROM tr_fill),
te_prep AS (SELECT * REPLACE (CASE WHEN Fare > 0 THEN ln(Fare) ELSE 0 END AS Fare),
                   SibSp + Parch + 1 AS Family, CASE WHEN SibSp + Parch + 1 = 1 THEN 0 ELSE 1 END AS isAlone,
                   CASE WHEN Age < 10 THEN 'child' ELSE Sex END AS Person FROM te_fill)"""


@query("P05_mask_filter", f"WITH {PASS_SQL} SELECT PassengerId, Age FROM ptrain WHERE Survived = 0 AND Age IS NOT NULL")
def p05_mask_filter(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return clean.where_present(train, F.col("Survived") == 0, ["Age"]).select("PassengerId", "Age")


@query("P06_conditional_assign", f"""WITH {PREP_SQL}
SELECT PassengerId, Family, isAlone FROM tr_prep UNION ALL SELECT PassengerId, Family, isAlone FROM te_prep""")
def p06_conditional_assign(spark, sf_dir):
    train, test = splits(T(spark, sf_dir))
    return (prepare(train).select("PassengerId", "Family", "isAlone")
            .unionByName(prepare(test).select("PassengerId", "Family", "isAlone")))


@query("P11_fill_median", f"""WITH {PREP_SQL}
SELECT PassengerId, {R('Age')} AS Age FROM tr_fill UNION ALL SELECT PassengerId, {R('Age')} FROM te_fill""")
def p11_fill_median(spark, sf_dir):
    train, test = splits(T(spark, sf_dir))
    return finish(clean.fill_median(train, ["Age"]).select("PassengerId", "Age")
                  .unionByName(clean.fill_median(test, ["Age"]).select("PassengerId", "Age")))


@query("P12_fill_mean", f"""WITH {PREP_SQL}
SELECT PassengerId, {R('Fare')} AS Fare FROM tr_fill UNION ALL SELECT PassengerId, {R('Fare')} FROM te_fill""")
def p12_fill_mean(spark, sf_dir):
    train, test = splits(T(spark, sf_dir))
    return finish(clean.fill_mean(train, ["Fare"]).select("PassengerId", "Fare")
                  .unionByName(clean.fill_mean(test, ["Fare"]).select("PassengerId", "Fare")))


@query("P13_drop_any_null", f"WITH {PASS_SQL} SELECT PassengerId FROM ptrain WHERE Age IS NOT NULL AND Fare IS NOT NULL AND Embarked IS NOT NULL")
def p13_drop_any_null(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return clean.drop_any_null(train).select("PassengerId")


@query("F11_guarded_log", f"""WITH {PASS_SQL}
SELECT PassengerId, {R('CASE WHEN Fare > 0 THEN ln(Fare) ELSE 0 END')} AS Fare FROM pass""")
def f11_guarded_log(spark, sf_dir):
    return finish(passengers(T(spark, sf_dir)).select("PassengerId", guarded_log("Fare").alias("Fare")))


@query("F17_conditional_category", f"""WITH {PASS_SQL}
SELECT PassengerId, CASE WHEN Age < 10 THEN 'child' ELSE Sex END AS Person FROM pass""")
def f17_conditional_category(spark, sf_dir):
    return passengers(T(spark, sf_dir)).select("PassengerId", child_or("Age", "Sex").alias("Person"))


def vectorize(train: DataFrame, test: DataFrame):
    """Fit the categories on train, apply to both (sorted columns)."""
    cats = encode.fit_categories(train, ["Person", "Embarked"])
    keep = ["PassengerId"] + SELECTED
    return (encode.dict_vectorize(train.select(*keep), cats),
            encode.dict_vectorize(test.select(*keep), cats))


# The categories of the driver tables.
SEXES, PORTS, PERSONS = ("female", "male"), ("C", "Q", "S"), ("child", "female", "male")


def _flags_sql(column: str, values: tuple[str, ...], name: str) -> str:
    return ", ".join(f"""CAST(coalesce({column} = '{v}', false) AS BIGINT) AS "{name}{v}\"""" for v in values)


@query("E03_dict_vectorize", f"""WITH {PREP_SQL}
SELECT PassengerId, Pclass, Family, {R('Fare')} AS Fare, isAlone,
       {_flags_sql("Embarked", PORTS, "Embarked=")}, {_flags_sql("Person", PERSONS, "Person=")} FROM tr_prep""")
def e03_dict_vectorize(spark, sf_dir):
    train, test = splits(T(spark, sf_dir))
    vt, _ = vectorize(prepare(train), prepare(test))
    flags = [c for c in vt.columns if "=" in c]
    return finish(vt.select("PassengerId", "Pclass", "Family", "Fare", "isAlone",
                            *[F.col(f"`{c}`").cast("long").alias(c) for c in flags]))


@query("E01_one_hot_strings", f"""WITH {PASS_SQL}
SELECT PassengerId, {_flags_sql("Sex", SEXES, "Sex_")}, {_flags_sql("Embarked", PORTS, "Embarked_")} FROM ptrain""")
def e01_one_hot_strings(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    df = train.select("PassengerId", "Sex", "Embarked")
    out = encode.one_hot(df, encode.fit_categories(df, ["Sex", "Embarked"]))
    return out.select("PassengerId", *[F.col(c).cast("long") for c in out.columns if c != "PassengerId"])


@query("J07_schema_join", f"""WITH {PREP_SQL}
SELECT PassengerId, Pclass, Person, Embarked, Family, {R('Fare')} AS Fare, isAlone FROM tr_prep
UNION ALL SELECT PassengerId, Pclass, Person, Embarked, Family, {R('Fare')}, isAlone FROM te_prep""")
def j07_schema_join(spark, sf_dir):
    """The training split has a column more (the label): both splits' rows
    with the columns they share."""
    train, test = splits(T(spark, sf_dir))
    keep = ["PassengerId"] + SELECTED
    a, b = encode.align(prepare(train).select(*keep, "Survived"), prepare(test).select(*keep))
    return finish(a.unionByName(b))


@query("P02_projection_by_type", f"WITH {PASS_SQL} SELECT PassengerId, Name, Sex, Embarked FROM ptrain")
def p02_projection_by_type(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return project.by_type(train, "string", keep=["PassengerId"])


# --- one-hot and dictionary vectors with any number of categories (E01, E03) ----------------------
# Every passenger's name is a category of its own.
NAMED = ["Name", "Sex", "Embarked"]


def _dictionary_sql(source: str, columns: list[str], numbers: tuple[str, ...] = ()) -> str:
    parts = [f"SELECT DISTINCT '{c}' AS col, {c} AS val, '{c}=' || {c} AS feature FROM {source} WHERE {c} IS NOT NULL" for c in columns]
    parts += [f"SELECT '{c}', NULL, '{c}'" for c in numbers]
    return (f"pairs AS ({' UNION ALL '.join(parts)}), "
            "dict AS (SELECT *, row_number() OVER (ORDER BY feature, col) - 1 AS idx FROM pairs)")


def _long_sql(source: str, columns: list[str], numbers: tuple[str, ...] = ()) -> str:
    parts = [f"SELECT PassengerId, idx, feature, 1.0::DOUBLE AS value FROM {source} JOIN dict ON col = '{c}' AND val = {c}" for c in columns]
    parts += [f"SELECT PassengerId, idx, feature, CAST({c} AS DOUBLE) FROM {source} JOIN dict ON col = '{c}' AND val IS NULL WHERE {c} <> 0"
              for c in numbers]
    return " UNION ALL ".join(parts)


@query("E01_one_hot_long", f"""WITH {PASS_SQL}, {_dictionary_sql('ptrain', NAMED)}
SELECT PassengerId, idx AS index, feature, {R('value')} AS value FROM ({_long_sql('ptrain', NAMED)})""")
def e01_one_hot_long(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return finish(encode.encode_long(train, "PassengerId", encode.fit_dictionary(train, NAMED), NAMED))


VECTOR_NUMBERS = ("Pclass", "Family", "Fare", "isAlone")


@query("E03_dict_vectorize_sparse", f"""WITH {PREP_SQL}, {_dictionary_sql('tr_prep', ['Name', 'Person', 'Embarked'], VECTOR_NUMBERS)},
long AS ({_long_sql('te_prep', ['Name', 'Person', 'Embarked'], VECTOR_NUMBERS)})
SELECT PassengerId, (SELECT count(*) FROM dict) AS size, count(*) AS n_values, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices,
       {R('sum(value)')} AS total FROM long GROUP BY PassengerId""")
def e03_dict_vectorize_sparse(spark, sf_dir):
    """Fitted on train, applied to test, whose names it has not seen."""
    train, test = (prepare(s) for s in splits(T(spark, sf_dir)))
    words = ["Name", "Person", "Embarked"]
    dictionary = encode.fit_dictionary(train, words, VECTOR_NUMBERS)
    out = encode.encode_sparse(test, "PassengerId", dictionary, words, VECTOR_NUMBERS)
    return finish(out.select("PassengerId", "size", F.size("indices").cast("long").alias("n_values"),
                             F.array_join(F.col("indices").cast("array<string>"), ",").alias("indices"),
                             F.aggregate("values", F.lit(0.0), lambda a, x: a + x).alias("total")))


# --- profiling and chart data on passengers (D01, D02, D04, D08, D09, D12) ----------------------
@query("D01_missing_table", f"""WITH {PASS_SQL},
m AS (SELECT count(*) AS n, {', '.join(f'count_if({c} IS NULL) AS {c}' for c in ['Age', 'Fare', 'Embarked', 'Sex'])} FROM ptrain),
l AS (UNPIVOT m ON Age, Fare, Embarked, Sex INTO NAME "column" VALUE missing)
SELECT "column", CAST(missing AS BIGINT) AS missing, round(missing * 100.0 / n, 1) AS percent FROM l WHERE missing > 0""")
def d01_missing_table(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return profile.missing_table(train.select("Age", "Fare", "Embarked", "Sex"))


@query("D02_distinct_per_string_column", f"""WITH {PASS_SQL}
SELECT 'Name' AS "column", count(DISTINCT Name) AS n_unique FROM ptrain
UNION ALL SELECT 'Sex', count(DISTINCT Sex) FROM ptrain
UNION ALL SELECT 'Embarked', count(DISTINCT Embarked) FROM ptrain""")
def d02_distinct_per_string_column(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return profile.distinct_counts(train, encode.string_columns(train))


@query("D04_value_counts", f"""WITH {PASS_SQL}
SELECT 'Embarked' AS "column", Embarked AS value, count(*) AS count FROM ptrain WHERE Embarked IS NOT NULL GROUP BY 2
UNION ALL SELECT 'Pclass', CAST(Pclass AS VARCHAR), count(*) FROM ptrain GROUP BY 2""")
def d04_value_counts(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return profile.value_counts(train, ["Embarked", "Pclass"])


@query("D08_stacked_histogram", f"""WITH {PASS_SQL},
b AS (SELECT min(Age) AS lo, max(Age) AS hi FROM ptrain),
h AS (SELECT Survived, CAST(least(floor((Age - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin
      FROM ptrain, b WHERE Age IS NOT NULL)
SELECT Survived, bin, count(*) AS count FROM h GROUP BY 1, 2""")
def d08_stacked_histogram(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return profile.histogram(train, "Age", bins=20, by="Survived").select("Survived", "bin", "count")


@query("D09_kde", f"""WITH {PASS_SQL},
d AS (SELECT Survived, Age FROM ptrain WHERE Age IS NOT NULL),
s AS (SELECT Survived, count(*) AS n, stddev_samp(Age) * pow(count(*), -0.2) AS bw, min(Age) AS lo, max(Age) AS hi
      FROM d GROUP BY Survived),
g AS (SELECT s.*, gi, lo - 3 * bw + gi * ((hi - lo + 6 * bw) / 49) AS x FROM s, range(50) r(gi))
SELECT g.Survived, CAST(gi AS INTEGER) AS gi, {R('x')} AS x,
       {R('sum(exp(-0.5 * ((x - Age) / bw) * ((x - Age) / bw))) / (n * bw * sqrt(2 * pi()))')} AS density
FROM g JOIN d USING (Survived) GROUP BY g.Survived, gi, x, n, bw""")
def d09_kde(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return finish(profile.kde(train, "Age", by="Survived", gridsize=50))


@query("D12_bar_data", f"""WITH {PASS_SQL}
SELECT Pclass, Sex, {R('avg(Survived)')} AS mean, {R('stddev_samp(Survived)')} AS std, count(*) AS n,
       {R('avg(Survived) - 1.96 * stddev_samp(Survived) / sqrt(count(*))')} AS ci_low,
       {R('avg(Survived) + 1.96 * stddev_samp(Survived) / sqrt(count(*))')} AS ci_high
FROM ptrain GROUP BY Pclass, Sex""")
def d12_bar_data(spark, sf_dir):
    train, _ = splits(T(spark, sf_dir))
    return finish(profile.bar_data(train, "Survived", "Pclass", "Sex"))


# --- classification metrics of a deterministic rule (V05, V06) --------------------------------------
# The prediction is the classic rule "survived if female or child".
RULE_SQL = f"""{PREP_SQL},
rule AS (SELECT PassengerId, Survived, CASE WHEN Person IN ('female', 'child') THEN 1 ELSE 0 END AS pred FROM tr_prep)"""


def rule_predictions(t) -> DataFrame:
    train, _ = splits(t)
    return prepare(train).select("PassengerId", "Survived",
                                 flag(F.col("Person").isin("female", "child")).alias("pred"))


@query("V05_accuracy", f"""WITH {RULE_SQL}
SELECT {R('avg(CAST(pred = Survived AS DOUBLE))')} AS accuracy, count(*) AS n FROM rule""")
def v05_accuracy(spark, sf_dir):
    return finish(metrics.accuracy(rule_predictions(T(spark, sf_dir)), "pred", "Survived"))


@query("V06_class_report", f"""WITH {RULE_SQL},
lab AS (SELECT Survived AS cls, count(*) AS support FROM rule GROUP BY 1),
prd AS (SELECT pred AS cls, count(*) AS predicted FROM rule GROUP BY 1),
hit AS (SELECT Survived AS cls, count(*) AS tp FROM rule WHERE pred = Survived GROUP BY 1),
t AS (SELECT coalesce(lab.cls, prd.cls) AS cls, coalesce(support, 0) AS support, coalesce(predicted, 0) AS predicted,
             coalesce(tp, 0) AS tp
      FROM lab FULL JOIN prd ON lab.cls = prd.cls LEFT JOIN hit ON coalesce(lab.cls, prd.cls) = hit.cls),
pr AS (SELECT cls, support, coalesce(CAST(tp AS DOUBLE) / NULLIF(predicted, 0), 0) AS p,
              coalesce(CAST(tp AS DOUBLE) / NULLIF(support, 0), 0) AS r FROM t)
SELECT cls, {R('p')} AS precision, {R('r')} AS recall, {R('coalesce(2 * p * r / NULLIF(p + r, 0), 0)')} AS f1,
       CAST(support AS BIGINT) AS support FROM pr""")
def v06_class_report(spark, sf_dir):
    return finish(metrics.class_report(rule_predictions(T(spark, sf_dir)), "pred", "Survived"))
