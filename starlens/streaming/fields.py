"""Field-level decode of events with VARIANT.

Each field of an event is looked at by itself: it can be missing, of a wrong
type, or unknown to the table.  A wrong type, text that is no JSON object and a
missing key make a reject with a reason; missing and unknown fields are
tolerated, as before, but counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starlens.sources.schemas import KEYS, SCHEMAS

MISSING, WRONG, UNKNOWN, NO_JSON, NO_OBJECT = "missing", "wrong type", "unknown", "not json", "not an object"
# Types of a JSON value that a column's type takes.
TAKES = {"string": "STRING", "double": "BIGINT|DOUBLE|FLOAT|DECIMAL\\(.*", "integer": "BIGINT"}


def _fault(field: Column | str | None, kind: str) -> Column:
    name = F.lit(field).cast("string") if field is None or isinstance(field, str) else field
    return F.struct(name.alias("field"), F.lit(kind).alias("kind"))


def decode_fields(raw: DataFrame, table: str) -> DataFrame:
    """(``value``) -> table columns, ``_raw``, ``_ok``, ``_reason`` and
    ``_faults``, an array of (field, kind).

    An explicit null is a value of any type, but not of the key.  A whole
    number in a string column, a string in a number column and a fraction or an
    out-of-range number in an integer column are wrong types.  Null text is
    not JSON."""
    text = F.col("value").cast("string")
    rows = raw.select(text.alias("_raw"), F.try_parse_json(text).alias("_v"))
    # Looked up once, as columns: a row's fields are told and tested several times.
    looked = [F.coalesce(F.schema_of_variant("_v").startswith("OBJECT"), F.lit(False)).alias("_object")]
    for f in SCHEMAS[table].fields:
        looked.append(F.schema_of_variant(F.try_variant_get("_v", f"$.{f.name}", "variant")).alias(f"_seen_{f.name}"))
        looked.append(F.try_variant_get("_v", f"$.{f.name}", f.dataType.simpleString()).alias(f"_value_{f.name}"))
    rows, is_object = rows.select("_raw", F.col("_v").isNull().alias("_no_json"), *looked), F.col("_object")
    values, faults = [], []
    for f in SCHEMAS[table].fields:
        kind = f.dataType.typeName()
        seen, value = F.col(f"_seen_{f.name}"), F.col(f"_value_{f.name}")
        wrong = (seen != "VOID") & (~seen.rlike(f"^({TAKES[kind]})$") | value.isNull())
        absent = seen.isNull() if f.name != KEYS[table] else seen.isNull() | (seen == "VOID")
        values.append(F.when(is_object, value).alias(f.name))
        faults.append(F.when(absent, _fault(f.name, MISSING)).when(wrong, _fault(f.name, WRONG)))
    known = F.array(*[F.lit(n) for n in SCHEMAS[table].names])
    more = F.transform(F.array_sort(F.array_except(F.coalesce(F.json_object_keys("_raw"), F.array().cast("array<string>")), known)),
                       lambda k: _fault(k, UNKNOWN))
    none = F.array(_fault(None, NO_JSON))
    found = F.when(F.col("_no_json"), none).when(~is_object, F.array(_fault(None, NO_OBJECT))).otherwise(
        F.concat(F.array_compact(F.array(*faults)), more))
    key = KEYS[table]
    wrong_ones = F.transform(F.filter("_faults", lambda x: x["kind"] == WRONG), lambda x: x["field"])
    keyless = F.exists("_faults", lambda x: (x["field"] == key) & (x["kind"] == MISSING))
    reason = (
        F.when(F.exists("_faults", lambda x: x["field"].isNull()), F.element_at("_faults", 1)["kind"])
        .when(F.size(wrong_ones) > 0, F.concat(F.lit(f"{WRONG}: "), F.array_join(wrong_ones, ", ")))
        .when(keyless, F.lit("no key")))
    out = rows.select("_raw", *values, found.alias("_faults")).withColumn("_reason", reason)
    return out.select(*SCHEMAS[table].names, "_raw", F.col("_reason").isNull().alias("_ok"), "_reason", "_faults")


def drift(decoded: DataFrame) -> DataFrame:
    """(field, kind, n): how often each fault occurs; field is null for text that is no JSON object."""
    return decoded.select(F.explode("_faults").alias("x")).groupBy(F.col("x.field").alias("field"), F.col("x.kind").alias("kind")).agg(
        F.count(F.lit(1)).alias("n"))


def merged_drift(parts: list[DataFrame]) -> DataFrame:
    """Counts of several batches or tables added up."""
    return reduce(DataFrame.unionByName, parts).groupBy("field", "kind").agg(F.sum("n").alias("n"))
