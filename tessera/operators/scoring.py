"""The deterministic score: labels, terms, caps, and the selection that follows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import fixed, scalars
from . import windows


def _map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])


def label(value: Column, known: list[str], synonyms: dict[str, str], default: str) -> Column:
    """A label in its enumeration: as it is, by synonym, or the safe default."""
    v = F.regexp_replace(F.replace(F.lower(F.trim(value)), F.lit("-"), F.lit("_")), "[^a-z0-9_]", "")
    return F.coalesce(F.when(v.isin(known), v), F.try_element_at(_map(synonyms), v), F.lit(default))


def was_coerced(value: Column, known: list[str], synonyms: dict[str, str]) -> Column:
    v = F.regexp_replace(F.replace(F.lower(F.trim(value)), F.lit("-"), F.lit("_")), "[^a-z0-9_]", "")
    mapped = F.try_element_at(_map(synonyms), v)
    return F.when(v.isin(known), False).when(mapped.isNotNull(), mapped != v).otherwise(True)


def labelled(df: DataFrame, content="content_type", action="actionability", substance="substance", topic="on_topic") -> DataFrame:
    """The four label columns brought into their enumerations, and whether any was coerced."""
    rules = [
        (content, list(fixed.BASE), fixed.CONTENT_SYNONYMS, fixed.SAFE_LABELS["content_type"]),
        (action, fixed.ACTIONABILITIES, fixed.ACTION_SYNONYMS, fixed.SAFE_LABELS["actionability"]),
        (substance, list(fixed.SUBSTANCE), fixed.SUBSTANCE_SYNONYMS, fixed.SAFE_LABELS["substance"]),
        (topic, list(fixed.OFF_TOPIC), fixed.TOPIC_SYNONYMS, fixed.SAFE_LABELS["on_topic"]),
    ]
    coerced = F.lit(False)
    for c, known, synonyms, _ in rules:
        coerced = coerced | F.coalesce(was_coerced(F.col(c), known, synonyms), F.lit(True))
    df = df.withColumn("coerced", coerced)
    return df.withColumns({c: label(F.col(c), known, synonyms, default) for c, known, synonyms, default in rules})


def base(content: Column, action: Column) -> Column:
    table = {f"{c}|{a}": v for c, row in fixed.BASE.items() for a, v in zip(fixed.ACTIONABILITIES, row)}
    return F.element_at(_map(table), F.concat(content, F.lit("|"), action))


def engagement(likes: Column, shares: Column, metric_likes: Column | None = None, metric_shares: Column | None = None) -> Column:
    """Likes and shares; the nested ones only where both are missing."""
    zero = F.lit(0.0)
    own = F.coalesce(likes.cast("double"), zero) + F.coalesce(shares.cast("double"), zero)
    if metric_likes is None:
        return own
    other = F.coalesce(metric_likes.cast("double"), zero) + F.coalesce(metric_shares.cast("double"), zero)
    return F.when(likes.isNull() & shares.isNull(), other).otherwise(own)


def engagement_points(value: Column, known: Column) -> Column:
    cap = F.when(known, float(fixed.ENGAGEMENT_CAP)).otherwise(float(fixed.ENGAGEMENT_CAP_UNKNOWN))
    return scalars.python_round(F.least(fixed.ENGAGEMENT_K * F.log10(1 + value.cast("double")), cap))


def crowd_points(points: Column) -> Column:
    raw = fixed.HN_K * F.log10(F.greatest(points.cast("double"), F.lit(1.0)) / fixed.HN_PIVOT)
    return scalars.python_round(scalars.clamp(raw, 0.0, float(fixed.HN_CAP)))


def author_points(leader: Column, tracked: Column) -> Column:
    return F.when(leader, fixed.AUTHOR_LEADER).when(tracked, fixed.AUTHOR_TRACKED).otherwise(0)


def fit_points(delta: Column) -> Column:
    return scalars.python_round(scalars.clamp(F.coalesce(delta.cast("double"), F.lit(0.0)), -float(fixed.FIT_CAP), float(fixed.FIT_CAP)))


def recency_points(hours: Column) -> Column:
    out = F.lit(0)
    for most, points in reversed(fixed.RECENCY):
        out = F.when(hours <= most, points).otherwise(out)
    return F.when(hours.isNull(), 0).otherwise(out)


def media_points(kind: Column, video: Column, image: Column) -> Column:
    k = F.lower(F.coalesce(kind, F.lit("")))
    return F.when(k.isin("video", "gif") | video, fixed.MEDIA_VIDEO).when(k.isin("photo", "image") | image, fixed.MEDIA_IMAGE).otherwise(0)


def scored(df: DataFrame, also_gate: int = fixed.ALSO_GATE, floor: int = fixed.LOW_REACH_FLOOR) -> DataFrame:
    """Adds ``final`` and its parts to rows with labels and columns engagement, known, leader, tracked, fit, hours, kind, is_x."""
    on = F.col("on_topic") != "off"
    df = df.withColumns({
        "base": base(F.col("content_type"), F.col("actionability")),
        "substance_points": F.element_at(_map(fixed.SUBSTANCE), F.col("substance")),
        "engagement_points": engagement_points(F.col("engagement"), F.col("known")),
        "author_points": F.when(on, author_points(F.col("leader"), F.col("tracked"))).otherwise(0),
        "fit_points": fit_points(F.col("fit")),
        "recency_points": recency_points(F.col("hours")),
        "media_points": media_points(F.col("kind"), F.lit(False), F.lit(False)),
        "topic_penalty": F.element_at(_map(fixed.OFF_TOPIC), F.col("on_topic")),
    })
    parts = ["base", "substance_points", "engagement_points", "author_points", "fit_points", "recency_points", "media_points"]
    total = sum((F.col(p) for p in parts[1:]), F.col(parts[0])) - F.col("topic_penalty")
    low = F.col("is_x") & ~F.col("known") & (F.col("engagement") < floor)
    total = F.when(low, F.least(total, F.lit(also_gate - 5))).otherwise(total)
    return df.withColumn("final", scalars.clamp(total, 0, 100))


def legacy_score(base_: Column, fit: Column, boost: Column, tracked: Column, leader: Column, low_reach: Column) -> Column:
    """The earlier score: base, fit, at most 15 of boost, 10 for a leader, 8 for a tracked author; at most 70 at low reach."""
    total = base_ + fit + F.least(boost, F.lit(15.0)) + F.when(leader, 10).when(tracked, 8).otherwise(0)
    return scalars.clamp(F.when(low_reach, F.least(total, F.lit(70.0))).otherwise(total), 0.0, 100.0)


def selected(df: DataFrame, order: list[Column], author: str, cap: int = 2, top_gate=fixed.TOP_GATE, also_gate=fixed.ALSO_GATE, max_top=fixed.MAX_TOP, max_also=fixed.MAX_ALSO, key: str | None = None) -> DataFrame:
    """Forced distribution, author cap, gates and slots over scored rows."""
    df = windows.forced_distribution(df, "final", order, "final", key)
    return windows.gated_slots(df, "final", order, top_gate, also_gate, max_top, max_also, author, cap, key)


def fused(keyword: Column, embed: Column, mean: Column) -> Column:
    """Mean of keyword affinity and embedding affinity about its pool's mean; the keyword's alone where there is no other."""
    return F.when(embed.isNull(), keyword).otherwise((keyword + (embed - mean)) / 2)


def keyword_affinity(topic: Column, author: Column, format_: Column, down: Column, is_x: Column, baseline: float = 0.18, weight: float = 30.0) -> Column:
    """Personal fit of a candidate from its parts, as points."""
    affinity = 0.42 * topic + 0.28 * author + 0.18 * format_ - 0.18 * down + F.when(is_x, 0.08).otherwise(0.0)
    return (affinity - baseline) * min(weight, 60.0)
