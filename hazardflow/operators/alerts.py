"""Alert rows, routing, message text and the outbox. Delivery is not done here."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from hazardflow import config
from hazardflow.functions import severity, text
from hazardflow.functions.time import moment

ALERT_COLUMNS = [
    "title", "message", "severity", "event_type", "location", "magnitude", "timestamp", "event_id",
]


def quake_alerts(df: DataFrame) -> DataFrame:
    """One alert per event; the level follows the magnitude."""
    magnitude = text.fixed_decimals(F.col("magnitude"), 1)
    return df.select(
        F.concat(F.lit("Earthquake Alert - Magnitude "), magnitude).alias("title"),
        F.concat(
            F.lit("A magnitude "), magnitude, F.lit(" earthquake has been detected near "),
            F.coalesce("place", F.lit("an unknown place")), F.lit("."),
        ).alias("message"),
        severity.alert_level_for_quake("magnitude").alias("severity"),
        F.lit("earthquake").alias("event_type"),
        F.col("place").alias("location"),
        F.col("magnitude"),
        F.col("event_time").alias("timestamp"),
        F.col("event_id"),
    )


def weather_alerts(df: DataFrame, as_of) -> DataFrame:
    """One alert per weather row, its level mapped to the routing levels."""
    return df.select(
        F.concat(F.lit("Weather Alert - "), F.coalesce("event_type", F.lit(""))).alias("title"),
        F.concat(
            F.coalesce("headline", F.lit("")), F.lit(" affecting "),
            F.coalesce("area_desc", F.lit("an unknown area")),
        ).alias("message"),
        severity.alert_level_for_weather("severity").alias("severity"),
        F.lit("weather").alias("event_type"),
        F.col("area_desc").alias("location"),
        F.lit(None).cast("double").alias("magnitude"),
        moment(as_of).alias("timestamp"),
        F.col("alert_id").alias("event_id"),
    )


def anomaly_alerts(df: DataFrame, as_of) -> DataFrame:
    """One alert per anomalous event, always medium."""
    score = text.fixed_decimals(F.col("anomaly_score"), 2)
    return df.filter("is_anomaly").select(
        F.concat(F.lit("Anomaly Detected - "), F.col("anomaly_types")).alias("title"),
        F.concat(F.lit("Anomaly score "), score, F.lit(" for event "), F.col("event_id")).alias(
            "message"
        ),
        F.lit(config.ANOMALY_ALERT_LEVEL).alias("severity"),
        F.lit("anomaly").alias("event_type"),
        F.col("place").alias("location"),
        F.lit(None).cast("double").alias("magnitude"),
        moment(as_of).alias("timestamp"),
        F.col("event_id"),
    )


def route(alerts: DataFrame) -> DataFrame:
    """One row per alert and channel."""
    urgent = F.col("severity").isin(*config.URGENT_LEVELS)
    channels = F.when(urgent, _texts(config.URGENT_CHANNELS)).otherwise(
        _texts(config.DEFAULT_CHANNELS)
    )
    return alerts.withColumn("channel", F.explode(channels))


def _texts(values) -> Column:
    return F.array(*[F.lit(value) for value in values])


def _icon() -> Column:
    return severity.lookup("event_type", config.EVENT_ICONS, config.DEFAULT_ICON)


def sms_text() -> Column:
    """Parts joined by bars, cut to the length limit; empty parts are left out."""
    magnitude = F.when(
        F.col("magnitude") != 0,
        F.concat(F.lit("Mag: "), text.fixed_decimals(F.col("magnitude"), 1)),
    )
    location = F.when(F.col("location") != "", F.concat(F.lit("Location: "), F.col("location")))
    whole = F.concat_ws(
        " | ",
        F.concat(_icon(), F.lit(" "), F.upper("severity")),
        F.col("title"),
        location,
        magnitude,
    )
    cut = F.concat(F.substring(whole, 1, config.SMS_LIMIT - 3), F.lit("..."))
    return F.when(F.length(whole) > config.SMS_LIMIT, cut).otherwise(whole)


def _object(**fields) -> Column:
    """JSON object; a NULL field is left out of the text."""
    parts = [(v if isinstance(v, Column) else F.lit(v)).alias(k) for k, v in fields.items()]
    return F.struct(*parts)


def _fact(title: str, value: Column) -> Column:
    return F.when(value.isNotNull(), _object(title=title, value=value))


def _text_block(content: Column, size: str, weight=None, color=None, wrap=None) -> Column:
    none, flag = F.lit(None).cast("string"), F.lit(None).cast("boolean")
    return _object(
        type="TextBlock",
        text=content,
        wrap=flag if wrap is None else wrap,
        size=size,
        weight=none if weight is None else weight,
        color=none if color is None else color,
    )


def card_json() -> Column:
    """Adaptive card of an alert row as JSON text."""
    level, body_type = F.col("severity"), "struct<type:string,style:string,items:{},facts:{}>"
    item = "array<struct<type:string,text:string,wrap:boolean,size:string,weight:string,color:string>>"
    fact = "array<struct<title:string,value:string>>"
    body_type = body_type.format(item, fact)

    def attention(*levels) -> Column:
        return F.when(level.isin(*levels), F.lit("Attention")).otherwise(F.lit("Default"))

    def part(kind: str, style=None, items=None, facts=None) -> Column:
        return _object(
            type=kind,
            style=F.lit(style),
            items=F.lit(None) if items is None else items,
            facts=F.lit(None) if facts is None else facts,
        ).cast(body_type)

    heading = F.array(
        _text_block(
            F.concat(_icon(), F.lit(" "), F.col("title")),
            "Large", "Bolder", attention(*config.URGENT_LEVELS),
        ),
        _text_block(
            F.concat(F.lit("**Severity:** "), level), "Medium", "Bolder", attention("Critical")
        ),
    )
    message = F.array(_text_block(F.col("message"), "Medium", wrap=True))
    location = F.when(F.col("location") != "", F.col("location"))
    facts = F.array_compact(F.array(
        _fact(
            "Magnitude:",
            F.when(F.col("magnitude") != 0, text.fixed_decimals(F.col("magnitude"), 1)),
        ),
        _fact("Time:", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss 'UTC'")),
        _fact("Event ID:", F.when(F.col("event_id") != "", F.col("event_id"))),
    ))
    body = F.array_compact(F.array(
        part("Container", "emphasis", heading),
        part("Container", None, message),
        F.when(
            location.isNotNull(),
            part("FactSet", facts=F.array(_object(title="Location:", value=location))),
        ),
        F.when(F.size(facts) > 0, part("FactSet", facts=facts)),
    ))
    actions = F.array(*[
        _object(type="Action.OpenUrl", title=title, url=url) for title, url in config.CARD_ACTIONS
    ])
    content = _object(
        type="AdaptiveCard",
        version=config.CARD_VERSION,
        body=body,
        actions=F.when(level == "Critical", actions),
    )
    attachment = _object(contentType=config.CARD_CONTENT_TYPE, content=content)
    return F.to_json(_object(type="message", attachments=F.array(attachment)))


def with_recipients(routed: DataFrame, recipients=None) -> DataFrame:
    """SMS rows once per recipient; other channels keep one row without one.

    An SMS with no recipient at all stays, with a NULL recipient.
    """
    numbers = [n for n in (recipients or config.CONTACTS[config.SMS_GROUP]) if n]
    listed = _texts(numbers) if numbers else F.array().cast("array<string>")
    fan_out = F.when(F.col("channel") == "sms", listed)
    return routed.withColumn("recipient", F.explode_outer(fan_out))


def rule_outbox(fired: DataFrame, alerts: DataFrame, contacts=None) -> DataFrame:
    """Deliveries of fired rules: the alert of the row, on the rule's channels, to its group.

    ``fired`` comes from ``apply_rules``, ``alerts`` has one row per event. A text message goes to
    every contact of the group, once for a contact; a group without contacts keeps one row with
    a NULL recipient.
    """
    groups = config.CONTACTS if contacts is None else contacts
    listed = F.lit(None).cast("array<string>")
    for name, members in groups.items():
        numbers = _texts([m for m in members if m]) if any(members) else F.array().cast("array<string>")
        listed = F.when(F.col("recipient_group") == name, numbers).otherwise(listed)
    rows = fired.select("event_id", "rule", "recipient_group", F.explode(F.split("channels", ",")).alias("channel"))
    payload = F.when(F.col("channel") == "sms", sms_text()).otherwise(card_json())
    known = rows.join(alerts, "event_id").withColumn("payload", payload)
    return known.withColumn("recipient", F.explode_outer(F.when(F.col("channel") == "sms", listed)))


def outbox(alerts: DataFrame, recipients=None) -> DataFrame:
    """Rows ready for delivery: alert, channel, recipient and payload."""
    payload = F.when(F.col("channel") == "sms", sms_text()).otherwise(card_json())
    return with_recipients(route(alerts).withColumn("payload", payload), recipients)


def delivery_rollup(results: DataFrame) -> DataFrame:
    """Per alert and channel: attempts, and success if any recipient succeeded."""
    return results.groupBy("event_id", "channel").agg(
        F.count("*").alias("attempts"),
        F.count_if("success").alias("delivered"),
        F.bool_or("success").alias("success"),
    )


def apply_rules(df: DataFrame, source: str, key: str, rules=None) -> DataFrame:
    """All rules of one source in one pass; a row appears once per rule it meets."""
    fired = [
        F.when(
            F.expr(condition),
            F.struct(
                F.lit(name).alias("rule"),
                F.lit(",".join(channels)).alias("channels"),
                F.lit(group).alias("recipient_group"),
            ),
        )
        for rule_source, name, condition, channels, group in (rules or config.ALERT_RULES)
        if rule_source == source
    ]
    return df.select(
        F.col(key).alias("event_id"), F.explode(F.array_compact(F.array(*fired))).alias("_rule")
    ).select(F.lit(source).alias("source"), "event_id", "_rule.*")
