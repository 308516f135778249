"""Rule catalogues: product -> rules on customer attributes, as rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RULE_SCHEMA = T.StructType(
    [
        T.StructField("product", T.StringType()),
        T.StructField("rule_no", T.IntegerType()),
        T.StructField("attribute", T.StringType()),
        T.StructField("kind", T.StringType()),
        T.StructField("min", T.DoubleType()),
        T.StructField("max", T.DoubleType()),
        T.StructField("values", T.ArrayType(T.StringType())),
    ]
)

# The eligibility rules of the four catalogues.
# A range rule is (attribute, min, max), None for an open bound; a membership rule is (attribute, [values]).
CATALOGUES = {
    "travel_insurance": {
        "rental vehicle excess insurance": [
            ("income", 25000, None), ("age", 30, None), ("agency", ["cwt", "epx"])],
        "ticket protector": [("income", 155000, None), ("age", 30, None), ("agency", ["jzi", "epx"])],
        "cancellation plan": [("income", 125000, None), ("age", 30, None), ("agency", ["jzi", "cwt"])],
    },
    "motor_insurance": {
        "multi-vehicle collision": [
            ("income", 25000, None), ("age", 20, None), ("policy_annual_premium", 30, None),
            ("vehicle_age_yrs", None, 20)],
        "parked car": [
            ("income", 25000, None), ("age", 20, 55), ("policy_annual_premium", 30, None),
            ("vehicle_age_yrs", None, 20)],
        "single vehicle collision": [
            ("income", 25000, None), ("age", 20, None), ("policy_annual_premium", 30, None),
            ("vehicle_age_yrs", None, None)],
        "vehicle theft": [
            ("income", 25000, None), ("age", 20, None), ("policy_annual_premium", 30, None),
            ("vehicle_age_yrs", None, None)],
    },
    "medical_insurance": {
        "cardiovascular": [("income", 25000, None), ("age", 30, None), ("bmi", None, 30)],
        "illness": [("income", 25000, None), ("age", 34, None), ("bmi", None, None)],
        "mental health": [("income", 25000, None), ("age", 30, None), ("bmi", None, None)],
        "dental": [("income", 25000, None), ("age", 34, None), ("bmi", None, None)],
    },
    "occupation": {
        "lawyer": [
            ("income", None, 500000), ("self_employed", ["Yes"]), ("years_of_experience", 5, None),
            ("number_of_private_firms", 6, None), ("score", 0.6, 0.8)],
        "doctor": [
            ("income", None, 700000), ("self_employed", ["Yes"]), ("years_of_experience", 5, None),
            ("number_of_private_clinics", 3, None), ("score", 0.5, 0.7)],
        "business": [
            ("income", None, 500000), ("self_employed", ["Yes"]), ("years_of_experience", 5, None),
            ("score", 0.7, 0.9)],
        "others": [("income", None, 300000), ("years_of_experience", 5, None), ("score", 0.3, 0.5)],
    },
}


def catalogue_rules(spark: SparkSession, name: str) -> DataFrame:
    """One of the shipped catalogues as rule rows."""
    rows = []
    for product, rules in CATALOGUES[name].items():
        for number, (attribute, *bounds) in enumerate(rules):
            if isinstance(bounds[0], list):
                rows.append((product, number, attribute, "list", None, None, bounds[0]))
            else:
                low, high = bounds
                rows.append((product, number, attribute, "int", _bound(low), _bound(high), None))
    return rule_rows(spark, rows)


def rule_rows(spark: SparkSession, rows: Iterable[tuple]) -> DataFrame:
    """Rule table from tuples in the order of ``RULE_SCHEMA``."""
    return spark.createDataFrame(list(rows), RULE_SCHEMA)


FILE_SCHEMA = (
    "block string, product string, rule_no int, attribute string, type string, "
    "required_values struct<min:string,max:string>, values array<string>, _corrupt string"
)
"""A rule file's lines: one JSON object per rule. Bounds are read as text, as open ones may be written as false."""
KINDS = ("int", "non-list", "list")


def read_rule_file(spark: SparkSession, path: str) -> DataFrame:
    """``block``, the columns of a rule table and ``refused`` for every line of the rule files under ``path``.

    Spark reads and checks the lines where they are. ``refused`` names the first fault of a line, NULL where there is none:
    not an object of this form, a name missing, a kind not known, a bound that is no number, a list without values. An open
    bound is left out, null or false; 0 is a bound.
    """
    lines = spark.read.schema(FILE_SCHEMA).option("columnNameOfCorruptRecord", "_corrupt").json(path)

    def bound(side: str) -> tuple[Column, Column]:
        text = F.nullif(F.lower(F.trim(F.col(f"required_values.{side}"))), F.lit("false"))
        number = F.nanvl(text.try_cast("double"), F.lit(None).cast("double"))
        return number.alias(side), text.isNotNull() & number.isNull()

    (low, bad_low), (high, bad_high) = bound("min"), bound("max")
    no_values = (F.col("type") == "list") & (F.coalesce(F.size(F.array_compact("values")), F.lit(0)) <= 0)
    faults = [
        (F.col("_corrupt").isNotNull(), "not a rule"),
        (F.col("block").isNull() | F.col("product").isNull() | F.col("attribute").isNull(), "name missing"),
        (~F.coalesce(F.col("type").isin(*KINDS), F.lit(False)), "unknown kind"),
        (bad_low | bad_high, "bound is no number"),
        (no_values, "list without values"),
    ]
    refused = F.coalesce(*[F.when(fault, F.lit(text)) for fault, text in faults])
    return lines.select(
        "block", "product", "rule_no", "attribute", F.col("type").alias("kind"), low, high, "values", refused.alias("refused"))


def read_rule_block(spark: SparkSession, path: str, block: str) -> DataFrame:
    """Rule table of one block; an error that names some faults when any line of the files is refused."""
    lines = read_rule_file(spark, path)
    if faults := lines.filter("refused IS NOT NULL").limit(20).collect():
        named = (f"{r.block}/{r.product}/{r.rule_no}: {r.refused}" for r in faults)
        raise ValueError(f"rule files under {path} are refused: {'; '.join(named)}")
    return lines.filter(F.col("block") == block).select(*RULE_SCHEMA.names)


def rule_lines(rules: DataFrame, block: str) -> DataFrame:
    """``value``: the lines of a rule file for one block, to be written with ``write.text``."""
    bounds = F.struct(F.col("min").cast("string").alias("min"), F.col("max").cast("string").alias("max")).alias("required_values")
    fields = [F.lit(block).alias("block"), "product", "rule_no", "attribute", F.col("kind").alias("type"), bounds, "values"]
    return rules.select(F.to_json(F.struct(*fields)).alias("value"))


def read_rules(spark: SparkSession, path: str, block: str) -> DataFrame:
    """One named block of a small hand-written YAML rule file as rule rows; ``path`` may be on any file system Spark reads."""
    import yaml

    text = "\n".join(r.value for r in spark.read.text(path, wholetext=True).collect())
    rows = []
    for product, rules in yaml.safe_load(text)[block].items():
        for number, rule in enumerate(rules or []):
            bounds = rule.get("required_values") or {}
            values = rule.get("values")
            rows.append(
                (
                    product, number, rule["attribute"], rule["type"],
                    _bound(bounds.get("min")), _bound(bounds.get("max")),
                    None if values is None else [str(v) for v in values],
                )
            )
    return rule_rows(spark, rows)


def _bound(value) -> float | None:
    """Open bounds are written as false or left out; 0 is a bound."""
    return None if value is None or value is False else float(value)
