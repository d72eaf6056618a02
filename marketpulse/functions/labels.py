"""Scalar column functions: direction, trend, thresholds, sentiment labels,
display names and number labels.  All are built-in Catalyst expressions, so
they stay inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketpulse.constants import (DEFAULT_THRESHOLD, MAX_THRESHOLD, MIN_THRESHOLD,  # noqa: F401 (re-exported)
                                   DROP_BODY_VERB, DROP_SUBJECT_VERB, NEGATIVE_BELOW, POSITIVE_ABOVE,
                                   RISE_BODY_VERB, RISE_SUBJECT_VERB, THRESHOLD_PHRASE, VOLUME_UNIT)


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nan_to_null(x) -> Column:
    """NaN poisons max/avg in Spark; the data model treats it as missing."""
    return F.nanvl(_c(x), F.lit(None).cast("double"))


def direction(change) -> Column:
    """``drop`` below zero, ``rise`` above, null for zero, null or NaN
    (Spark orders NaN above every number)."""
    c = nan_to_null(change)
    return F.when(c < 0, F.lit("drop")).when(c > 0, F.lit("rise"))


def effective_threshold(threshold) -> Column:
    """A missing threshold (NaN is one) means the default 2.0."""
    return F.coalesce(nan_to_null(threshold), F.lit(DEFAULT_THRESHOLD))


def threshold_hit(change, threshold, dirn) -> Column:
    """Inclusive hit test, two branches (differs from ``abs`` for negative t).
    Nothing hits or is hit by NaN, which Spark orders above every number."""
    c, t, d = nan_to_null(change), nan_to_null(threshold), _c(dirn)
    return ((d == "drop") & (c <= -t)) | ((d == "rise") & (c >= t))


def trend(change) -> Column:
    """``up`` for change >= 0 (zero is up), ``down`` otherwise incl. null and NaN."""
    c = nan_to_null(change)
    return F.when(c >= 0, F.lit("up")).otherwise(F.lit("down"))


def sentiment_label(score) -> Column:
    """P5: strict bounds; exactly +-0.1 is neutral."""
    s = _c(score)
    return (
        F.when(s > POSITIVE_ABOVE, F.lit("positive"))
        .when(s < NEGATIVE_BELOW, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def display_name(name) -> Column:
    """First letter upper, the rest lower (not word-wise ``initcap``)."""
    n = _c(name)
    return F.concat(F.upper(F.substr(n, F.lit(1), F.lit(1))), F.lower(F.substr(n, F.lit(2))))


def _plain_fixed(x, digits: int) -> Column:
    """Fixed-point text with HALF_EVEN rounding and no grouping."""
    return F.replace(F.format_number(_c(x), digits), F.lit(","), F.lit(""))


def price_label(price) -> Column:
    """P10: ``$1,234.5678`` (grouped, 4 dp)."""
    return F.concat(F.lit("$"), F.format_number(_c(price), 4))


def change_label(change) -> Column:
    """P10: ``-1.23%`` (2 dp)."""
    return F.concat(_plain_fixed(change, 2), F.lit("%"))


def volume_label(volume) -> Column:
    """P10: volume in billions, ``$12.34B``."""
    return F.concat(F.lit("$"), _plain_fixed(_c(volume) / F.lit(VOLUME_UNIT), 2), F.lit("B"))


def describe_subscription(dirn, threshold) -> Column:
    """``Drops by 2.5%`` / ``Rises by 2.5%``."""
    d, t = _c(dirn), _c(threshold)
    verb = F.when(d == "drop", F.lit("Drops")).otherwise(F.lit("Rises"))
    return F.concat(verb, F.lit(" by "), t.cast("string"), F.lit("%"))


def alert_subject(coin, dirn, change) -> Column:
    """P9 subject: name, verb by direction, |change| at 2 dp."""
    verb = F.when(_c(dirn) == "drop", F.lit(DROP_SUBJECT_VERB)).otherwise(F.lit(RISE_SUBJECT_VERB))
    return F.concat(
        F.lit("Price alert: "), display_name(coin), F.lit(" "), verb, F.lit(" "),
        _plain_fixed(F.abs(_c(change)), 2), F.lit("%"),
    )


def alert_body_head(coin, dirn, change, price) -> Column:
    """The tick part of the P9 body (everything before the threshold)."""
    verb = F.when(_c(dirn) == "drop", F.lit(DROP_BODY_VERB)).otherwise(F.lit(RISE_BODY_VERB))
    return F.concat(
        display_name(coin), F.lit(" has "), verb, F.lit(" "), _plain_fixed(F.abs(_c(change)), 2),
        F.lit("% over 24h. Price now $"), F.coalesce(F.format_number(_c(price), 4), F.lit("n/a")),
        F.lit(f". {THRESHOLD_PHRASE}: "),
    )


def alert_body_tail(head, threshold) -> Column:
    """Completes a body head with the subscriber's threshold."""
    return F.concat(_c(head), _c(threshold).cast("string"), F.lit("%."))


def alert_body(coin, dirn, change, price, threshold) -> Column:
    """P9 body: movement, grouped price at 4 dp and the subscriber's threshold."""
    return alert_body_tail(alert_body_head(coin, dirn, change, price), threshold)
