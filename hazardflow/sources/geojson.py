"""GeoJSON feature collections to bronze rows, with a quarantine for bad features.

Documents arrive as landed files (``read_*``) or as a JSON text column
(``from_text``). Both explode to one row per feature on the executors; one
document is one poll of a feed and is small, the number of documents is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from hazardflow import config, schemas
from hazardflow.functions import geo, text
from hazardflow.functions.sql import literal
from hazardflow.functions.stats import computed_once
from hazardflow.functions.time import moment

QUAKE_SOURCE, WEATHER_SOURCE, API_VERSION = "usgs_api", "noaa_api", "1.0"


def read_documents(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Landed files. One document per line splits; ``multi_line`` is one per file."""
    lines = spark.read.text(path, wholetext=multi_line)
    return from_text(lines.filter("trim(value) != ''"), "value")


def from_text(df: DataFrame, column: str) -> DataFrame:
    """Documents of a text column: ``features``, an array of variants, and the text of one that is unreadable.

    A document is parsed once, to a variant; its features are parts of it and are not parsed again. This is
    a step of its own: exploding a parsed column directly would make the optimizer add an is-not-empty
    filter that parses every text again.
    """
    parsed = computed_once(df.select(F.col(column).alias("_text")), {"_document": F.expr("try_parse_json(_text)")})
    listed = computed_once(parsed, {"features": F.expr("try_variant_get(_document, '$.features', 'array<variant>')")})
    other = "try_variant_get(_document, '$.features', 'variant')"
    bad = (
        f"_document IS NULL OR {other} IS NOT NULL AND NOT is_variant_null({other})"
        " OR schema_of_variant(_document) NOT LIKE 'OBJECT%'"
    )
    return listed.select("features", F.expr(f"CASE WHEN features IS NULL AND ({bad}) THEN _text END").alias("_corrupt_record"))


def _features(documents: DataFrame) -> DataFrame:
    """One row per element of ``features``, a variant; one that is no object has no fields."""
    return documents.select(F.explode("features").alias("feature"))


def rejected_documents(documents: DataFrame) -> DataFrame:
    """Documents without a list of features, with the text where it could not be read."""
    return documents.filter("features IS NULL").select(
        F.col("_corrupt_record").alias("document"),
        F.when(F.col("_corrupt_record").isNotNull(), "unreadable").otherwise("no features").alias("reason"),
    )


def _text(path: str) -> str:
    """Text of a field; NULL if it is absent, null or below something that is no object."""
    return f"try_variant_get(feature, {literal('$.' + path)}, 'string')"


def _present(path: str) -> str:
    """Whether a field is there, be it null."""
    return f"try_variant_get(feature, {literal('$.' + path)}, 'variant') IS NOT NULL"


def _property(name: str, default: str = "") -> str:
    """Text of a property: the default if the key is absent, NULL if it is null."""
    path = f"properties.{name}"
    return f"CASE WHEN {_present(path)} THEN {_text(path)} ELSE {literal(default)} END"


def _has_properties(*usual: str) -> str:
    """Whether ``properties`` is an object: sure if it has one of the usual keys, else its type tells."""
    known = " OR ".join(_present(f"properties.{name}") for name in usual)
    kind = "schema_of_variant(try_variant_get(feature, '$.properties', 'variant'))"
    return f"({known} OR coalesce({kind} LIKE 'OBJECT%', false))"


def _whole(value: str) -> str:
    """Whole number from numeric text, the fraction cut off."""
    number = f"try_cast({value} AS DOUBLE)"
    return f"CAST(signum({number}) AS BIGINT) * CAST(floor(abs({number})) AS BIGINT)"


_QUAKE_TEXTS = {
    "net": ("net", ""),
    "code": ("code", ""),
    "place": ("place", ""),
    "magnitude_type": ("magType", ""),
    "event_type": ("type", "earthquake"),
    "status": ("status", ""),
    "alert_level": ("alert", ""),
    "detail_url": ("detail", ""),
    "url": ("url", ""),
}
# bronze column -> (path, kind); a value that is not a number rejects the feature
_QUAKE_NUMBERS = {
    "longitude": ("geometry.coordinates[0]", "double"),
    "latitude": ("geometry.coordinates[1]", "double"),
    "depth_km": ("geometry.coordinates[2]", "double"),
    "magnitude": ("properties.mag", "double"),
    "cdi": ("properties.cdi", "double"),
    "mmi": ("properties.mmi", "double"),
    "nst": ("properties.nst", "whole"),
    "gap": ("properties.gap", "double"),
    "dmin": ("properties.dmin", "double"),
    "rms": ("properties.rms", "double"),
    "felt_reports": ("properties.felt", "whole"),
    "event_time": ("properties.time", "time"),
    "updated_time": ("properties.updated", "time"),
}


def _truthy(value: str) -> str:
    number = f"try_cast({value} AS DOUBLE)"
    return (
        f"CASE WHEN {value} IS NULL OR {value} = '' OR lower({value}) = 'false' THEN false"
        f" WHEN {number} IS NOT NULL THEN {number} != 0 ELSE true END"
    )


def _quake_columns(documents: DataFrame, as_of, batch_id: str) -> DataFrame:
    """Every bronze column plus ``reasons``, which is NULL on good features.

    What decides on a rejection is looked up once per feature, the texts only where they are used.
    """
    numbers = {f"_{name}": F.expr(_text(path)) for name, (path, _) in _QUAKE_NUMBERS.items()}
    looked_up = computed_once(_features(documents), numbers)
    texts = {name: _property(key, default) for name, (key, default) in _QUAKE_TEXTS.items()}

    columns = {"event_id": f"coalesce({_text('id')}, '')", **texts}
    for name, (_, kind) in _QUAKE_NUMBERS.items():
        columns[name] = f"try_cast(_{name} AS DOUBLE)" if kind == "double" else _whole(f"_{name}")
        if kind == "time":
            columns[name] = f"timestamp_millis(nullif({columns[name]}, 0))"
    columns["significance"] = _whole("_significance")
    columns["tsunami_warning"] = _truthy("_tsunami")
    columns["data_source"] = literal(QUAKE_SOURCE)
    columns["api_version"] = literal(API_VERSION)
    columns["batch_id"] = literal(batch_id)

    problems = {
        "properties": f"NOT {_has_properties('time', 'mag', 'sig')}",
        "coordinates": f"NOT {_present('geometry.coordinates[2]')}",
        "significance": "try_cast(_significance AS DOUBLE) IS NULL",
    }
    for name in _QUAKE_NUMBERS:
        problems[name] = f"_{name} IS NOT NULL AND try_cast(_{name} AS DOUBLE) IS NULL"
    named = ", ".join(f"CASE WHEN {bad} THEN {literal(name)} END" for name, bad in problems.items())
    reasons = F.expr(f"split(nullif(concat_ws(',', {named}), ''), ',')")
    words = {"_significance": F.expr(_property("sig", "0")), "_tsunami": F.expr(_text("properties.tsunami"))}
    judged = computed_once(computed_once(looked_up, words), {"reasons": reasons})
    return judged.withColumn("ingestion_time", moment(as_of)).selectExpr(
        *[
            "ingestion_time" if name == "ingestion_time" else f"{columns[name]} AS {name}"
            for name in schemas.BRONZE_QUAKES.names
        ],
        "reasons",
    )


def parse_quakes(documents: DataFrame, as_of, batch_id: str, figures: Observation | None = None) -> DataFrame:
    """Bronze rows; a malformed feature is left out, see ``rejected_quakes``.

    ``figures`` gets the features read (rows_in) and kept (rows_kept) once the rows are written.
    """
    parsed = _quake_columns(documents, as_of, batch_id)
    if figures is not None:
        parsed = parsed.observe(figures, F.count("*").alias("rows_in"), F.count_if(F.col("reasons").isNull()).alias("rows_kept"))
    return parsed.filter(F.col("reasons").isNull()).drop("reasons")


def rejected_quakes(documents: DataFrame, as_of, batch_id: str) -> DataFrame:
    """The features ``parse_quakes`` leaves out, with the fields that made it so."""
    return _quake_columns(documents, as_of, batch_id).filter(F.col("reasons").isNotNull())


def parse_quakes_strict(documents: DataFrame, as_of, batch_id: str) -> DataFrame:
    """Validated variant with defaults for depth, place and time."""
    parsed = parse_quakes(documents, as_of, batch_id)
    valid = parsed.filter(
        geo.coordinates_valid(F.col("latitude"), F.col("longitude"))
        & F.col("magnitude").between(*config.MAGNITUDE_RANGE)
    )
    return valid.withColumns({
        "depth_km": F.coalesce("depth_km", F.lit(0.0)),
        "place": F.when(F.col("place") == "", F.lit("Unknown")).otherwise(F.col("place")),
        "event_time": F.coalesce(F.col("event_time"), moment(as_of)),
        "location": text.location_text(F.col("latitude"), F.col("longitude")),
    })


_WEATHER_TEXTS = {
    "alert_id": "id",
    "identifier": "identifier",
    "sender": "sender",
    "sender_name": "senderName",
    "event_type": "event",
    "headline": "headline",
    "description": "description",
    "instruction": "instruction",
    "severity": "severity",
    "certainty": "certainty",
    "urgency": "urgency",
    "response_type": "response",
    "area_desc": "areaDesc",
    "message_type": "messageType",
    "category": "category",
    "status": "status",
}
_WEATHER_TIMES = {
    "sent_time": "sent",
    "effective_time": "effective",
    "onset_time": "onset",
    "expires_time": "expires",
    "ends_time": "ends",
}


_WEATHER_KEYS = ("id", "event", "severity")


def parse_weather(documents: DataFrame, as_of, batch_id: str, figures: Observation | None = None) -> DataFrame:
    """Bronze rows; a bad time becomes NULL, a feature without properties is left out.

    ``figures`` gets the features read (rows_in) and kept (rows_kept) once the rows are written.
    """
    geometry = F.expr(_text("geometry"))
    columns = {name: F.expr(_property(key)) for name, key in _WEATHER_TEXTS.items()}
    columns.update({name: text.parse_iso(F.expr(_text(f"properties.{key}"))) for name, key in _WEATHER_TIMES.items()})
    columns.update({
        "geocode": F.expr(_property("geocode", "{}")),
        "geometry": F.when(~geometry.isin("", "{}", "[]"), geometry),
        "ingestion_time": moment(as_of),
        "data_source": F.lit(WEATHER_SOURCE),
        "api_version": F.lit(API_VERSION),
        "batch_id": F.lit(batch_id),
    })
    features, good = _features(documents), F.expr(_has_properties(*_WEATHER_KEYS))
    if figures is not None:
        features = features.observe(figures, F.count("*").alias("rows_in"), F.count_if(good).alias("rows_kept"))
    return features.filter(good).select(*[columns[name].alias(name) for name in schemas.BRONZE_WEATHER.names])


def rejected_weather(documents: DataFrame) -> DataFrame:
    """The features ``parse_weather`` leaves out: those without properties."""
    rows = _features(documents).filter(f"NOT {_has_properties(*_WEATHER_KEYS)}")
    return rows.select(F.to_json("feature").alias("raw_feature"), F.array(F.lit("properties")).alias("reasons"))
