"""Scalar helpers as column expressions: names, text marks, colours, schedules and losses."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def url_name(url: Column) -> Column:
    """File name of an address: its last path part, decoded, without the query."""
    return F.url_decode(F.regexp_extract(F.regexp_replace(url, r"[?#].*$", ""), r"([^/]*)$", 1))


def is_ascii(text: Column) -> Column:
    return F.octet_length(text) == F.char_length(text)


def is_chinese(text: Column) -> Column:
    return text.rlike("[一-鿿]")


def hex_rgb(code: Column) -> list[Column]:
    """Red, green and blue of a code such as #FF3838."""
    return [F.conv(F.substring(code, at, 2), 16, 10).cast("int") for at in (2, 4, 6)]


#: Colours of classes, in order; class k has colour k modulo their number.
PALETTE = "FF3838 FF9D97 FF701F FFB21D CFD231 48F90A 92CC17 3DDB86 1A9334 00D4BB 2C99A8 00C2FF 344593 6473FF 0018EC 8438FF 520085 CB38FF FF95C8 FF37C7".split()


def class_colour(cls: Column) -> Column:
    return F.concat(F.lit("#"), F.get(F.array(*map(F.lit, PALETTE)), F.pmod(cls, F.lit(len(PALETTE))).cast("int")))


def interpolated(x: Column, x0: float, x1: float, y0: float, y1: float) -> Column:
    """Linear from (x0, y0) to (x1, y1), constant beyond: warm-up of a rate or momentum."""
    return y0 + (y1 - y0) * F.greatest(F.lit(0.0), F.least(F.lit(1.0), (x - x0) / (x1 - x0)))


def smoothed_targets(eps: float = 0.1) -> tuple[float, float]:
    """Positive and negative targets of label smoothing."""
    return 1 - 0.5 * eps, 0.5 * eps


def bce(logit: Column, target: Column) -> Column:
    """Binary cross-entropy of a logit, stable for large values."""
    return F.greatest(logit, F.lit(0.0)) - logit * target + F.log1p(F.exp(-F.abs(logit)))


def focal(logit: Column, target: Column, gamma: float = 1.5, alpha: float = 0.25) -> Column:
    """Cross-entropy that weighs well-classified rows down."""
    p = 1 / (1 + F.exp(-logit))
    hit = target * p + (1 - target) * (1 - p)
    return bce(logit, target) * (target * alpha + (1 - target) * (1 - alpha)) * F.pow(1 - hit, F.lit(gamma))


def quality_focal(logit: Column, target: Column, gamma: float = 1.5, alpha: float = 0.25) -> Column:
    """Cross-entropy with soft targets, weighed by the distance of the probability from the target."""
    away = F.abs(target - 1 / (1 + F.exp(-logit)))
    return bce(logit, target) * (alpha * target + (1 - alpha) * (1 - target)) * F.pow(away, F.lit(gamma))


def blurred_bce(logit: Column, target: Column, alpha: float = 0.05) -> Column:
    """Cross-entropy that counts less where the prediction exceeds the target by nearly 1: likely a missing label."""
    above = 1 / (1 + F.exp(-logit)) - target
    return bce(logit, target) * (1 - F.exp((above - 1) / (alpha + 1e-4)))


def balanced_levels(losses: Column, start: list[float], pivot: int, decay: float = 0.9999) -> Column:
    """Weights of the output levels after a run of batches: array of arrays of each level's objectness loss.

    A level's weight moves towards 1 / its loss by 1 - decay each batch; then all are divided by that of the pivot level.
    """

    def step(weights: Column, batch: Column) -> Column:
        moved = F.zip_with(weights, batch, lambda w, x: w * decay + (1 - decay) / x)
        return F.transform(moved, lambda w: w / F.get(moved, F.lit(pivot)))

    return F.aggregate(losses, F.array(*[F.lit(float(w)) for w in start]), step)


def colour_tables(hue: Column, saturation: Column, value: Column) -> list[Column]:
    """Lookup tables over 0..255 of a colour change by three gains: hue wraps at 180, the others saturate at 255."""
    x = F.sequence(F.lit(0), F.lit(255))
    wrap = F.transform(x, lambda v: F.floor(F.pmod(v * hue, F.lit(180.0))).cast("int"))
    level = lambda gain: F.transform(x, lambda v: F.floor(F.least(F.greatest(v * gain, F.lit(0.0)), F.lit(255.0))).cast("int"))
    return [wrap, level(saturation), level(value)]


def equalised(counts: Column) -> Column:
    """Lookup table that spreads a histogram of 256 counts evenly, from its first level that occurs; identity if there is one level only."""
    total = F.aggregate(counts, F.lit(0).cast("long"), lambda s, c: s + c)
    start = F.aggregate(counts, F.lit(0).cast("long"), lambda s, c: F.when(s > 0, s).otherwise(c))
    sums = F.aggregate(counts, F.array().cast("array<bigint>"), lambda acc, c: F.concat(acc, F.array(c + F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)))))
    spread = F.transform(sums, lambda s: F.greatest(F.lit(0), F.bround((s - start) * 255.0 / (total - start), 0).cast("int")))
    return F.when(total > start, spread).otherwise(F.transform(sums, lambda s, i: i))


def as_id(stem: Column) -> Column:
    """Digits as the number they spell, without leading zeros; other names stay (ids are strings, so one column holds both)."""
    return F.coalesce(F.when(stem.rlike("^[0-9]+$"), stem.try_cast("decimal(38,0)").cast("string")), stem)


def age_in_days(modified: Column, now: Column) -> Column:
    """Whole days since a file's change, and by that its date."""
    return F.datediff(now, modified)


def unscaled_view(box: tuple[Column, ...], scale: Column, flip: Column, width: float, height: float) -> tuple[Column, ...]:
    """Corners in the original image of a box found in a scaled and flipped view; flip: 0 none, 1 up-down, 2 left-right."""
    x1, y1, x2, y2 = (c / scale for c in box)
    lr, ud = flip == 2, flip == 1
    return F.when(lr, width - x2).otherwise(x1), F.when(ud, height - y2).otherwise(y1), F.when(lr, width - x1).otherwise(x2), F.when(ud, height - y1).otherwise(y2)
