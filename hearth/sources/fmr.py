"""Fair-market-rent responses, which come in several JSON shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hearth.functions import clean
from hearth.operators.lookup import latest_per_key

# Response keys of the five bedroom sizes, and the metro-wide row's label.
BEDROOMS = [
    ("fmr_0br", "Efficiency"),
    ("fmr_1br", "One-Bedroom"),
    ("fmr_2br", "Two-Bedroom"),
    ("fmr_3br", "Three-Bedroom"),
    ("fmr_4br", "Four-Bedroom"),
]
METRO_WIDE = "msa level"


def _text(v, path: str) -> Column:
    return F.try_variant_get(v, path, "string")


def parse(responses: DataFrame) -> DataFrame:
    """Rows of (entity_id, requested_year, payload) -> one row per response with usable amounts.

    ``data`` is an object or an object written as text. Its amounts sit in
    ``basicdata`` (an object, or a list with one metro-wide row) or directly on
    ``data``. Responses that cannot be read, and responses whose five amounts
    are all empty or zero, drop out.
    """
    raw = responses.select("*", F.try_parse_json("payload").alias("__v"))
    as_object = F.try_variant_get("__v", "$.data", "variant")
    as_text = F.when(F.schema_of_variant(as_object) == "STRING", F.try_parse_json(_text("__v", "$.data")))
    data = raw.withColumn("__d", F.coalesce(as_text, F.when(F.schema_of_variant(as_object).startswith("OBJECT"), as_object)))
    base = data.withColumn("__b", F.try_variant_get("__d", "$.basicdata", "variant"))

    shape = F.coalesce(F.schema_of_variant("__b"), F.lit("VOID"))
    as_list = F.try_variant_get("__b", "$", "array<variant>")
    label = lambda r: F.lower(F.trim(F.coalesce(_text(r, "$.zip_code"), F.lit(""))))
    metro_wide = F.get(F.filter(as_list, lambda r: label(r) == METRO_WIDE), F.lit(0))
    row = (
        F.when(shape.startswith("ARRAY"), F.coalesce(metro_wide, F.get(as_list, F.lit(0))))
        .when(shape.startswith("OBJECT"), F.col("__b"))
        .otherwise(F.col("__d"))
    )
    year_text = _text("__d", "$.year")
    found = F.struct(
        F.coalesce(_text("__d", "$.metro_name"), F.lit("")).alias("metro_name"),
        F.when(year_text.isNull(), F.col("requested_year")).otherwise(year_text.try_cast("int")).alias("fmr_year"),
        *[clean.money(_text("__r", f'$["{key}"]')).alias(name) for name, key in BEDROOMS],
        F.try_variant_get("__d", '$["FMR Percentile"]', "int").alias("fmr_percentile"),
        clean.flag_one(_text("__d", "$.smallarea_status")).alias("smallarea_flag"),
    )
    # Unusable rows are dropped inside the generator. A filter above it would be
    # pushed down and parse every document again for each amount it tests.
    usable = F.filter(
        F.array(found),
        lambda r: r["fmr_year"].isNotNull() & (F.greatest(*[F.coalesce(F.abs(r[n]), F.lit(0.0)) for n, _ in BEDROOMS]) > 0),
    )
    return base.withColumn("__r", row).select("entity_id", "requested_year", F.inline(usable))


def newest_year(parsed: DataFrame) -> DataFrame:
    """One row per entity: the answer to its newest request that has usable amounts."""
    cols = [c for c in parsed.columns if c not in ("entity_id", "requested_year")]
    return latest_per_key(parsed, ["entity_id"], ["requested_year", "fmr_year"], cols)


def staged_fmr(responses: DataFrame, crosswalk: DataFrame, load_date, newest_only: bool = True) -> DataFrame:
    rows = parse(responses)
    rows = newest_year(rows) if newest_only else rows.drop("requested_year")
    return rows.join(crosswalk, ["entity_id"], "inner").withColumn("load_date", F.lit(load_date).cast("date"))


def by_bedroom(fmr: DataFrame, keys=("entity_id", "city", "fmr_year")) -> DataFrame:
    """Long form: one row per bedroom size."""
    names = [n for n, _ in BEDROOMS]
    return fmr.unpivot(list(keys), names, "bedroom", "fair_market_rent").filter(F.col("fair_market_rent").isNotNull())
