"""Column expressions for the QoS layers.

All are built-in Catalyst expressions, so they stay inside whole-stage
codegen; none of them needs Python at run time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playback_qos.schema import TIERS

# Ranking used when ``quality_order="height"``: tier name -> vertical resolution.
TIER_HEIGHT = {"240p": 240, "360p": 360, "480p": 480, "720p": 720, "1080p": 1080}


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def clamp_non_negative(x) -> Column:
    """Negative -> 0; null stays null; type is kept."""
    c = _c(x)
    return F.when(c < 0, F.lit(0)).otherwise(c)


def total_received(src="src_receivedData", p2p="p2p_receivedData") -> Column:
    """Bytes received from the CDN plus bytes from peers; never null."""
    return F.coalesce(_c(src), F.lit(0).cast(T.LongType())) + F.coalesce(
        _c(p2p), F.lit(0).cast(T.LongType())
    )


def ratio_or_zero(numerator, denominator) -> Column:
    """``numerator / denominator`` when the denominator is positive, else 0.0.

    The numerator is not coalesced: a null numerator over a positive
    denominator stays null, and ``avg`` later skips that row.
    """
    den = _c(denominator)
    return F.when(den > 0, _c(numerator) / den).otherwise(F.lit(0.0))


def tier_column(tier: str) -> str:
    return f"quality_{tier}"


def tier_ranking(quality_order: str = "lexical", tiers=TIERS) -> list:
    """Tier names from lowest to highest under ``quality_order``."""
    if quality_order == "lexical":
        return sorted(tiers)
    if quality_order == "height":
        return sorted(tiers, key=lambda t: TIER_HEIGHT[t])
    raise ValueError(f"unknown quality_order {quality_order!r}")


def quality_rank(col="dominant_quality", quality_order: str = "lexical") -> Column:
    """1-based rank of a tier name (null for null), so that ``max`` can run on an
    int buffer (hash aggregate) instead of a string buffer (sort aggregate)."""
    names = F.array(*[F.lit(t) for t in tier_ranking(quality_order)])
    pos = F.array_position(names, _c(col))
    return F.when(pos > 0, pos.cast("int"))


def quality_name(rank_col, quality_order: str = "lexical") -> Column:
    """Inverse of :func:`quality_rank`."""
    names = F.array(*[F.lit(t) for t in tier_ranking(quality_order)])
    r = _c(rank_col)
    return F.when(r.isNotNull(), F.element_at(names, r))


def dominant_quality(quality_order: str = "lexical", tiers=TIERS) -> Column:
    """Highest tier present on the event (a present tier has a non-null value).

    ``lexical`` (default) compares tier names as strings, so ``720p`` beats
    ``1080p``; ``height`` ranks by resolution. Null when no tier is present.
    """
    if quality_order == "lexical":
        return F.greatest(
            *[F.when(F.col(tier_column(t)).isNotNull(), F.lit(t)) for t in tiers]
        )
    if quality_order == "height":
        best = F.greatest(
            *[
                F.when(F.col(tier_column(t)).isNotNull(), F.lit(TIER_HEIGHT[t]))
                for t in tiers
            ]
        )
        return F.when(best.isNotNull(), F.concat(best.cast("string"), F.lit("p")))
    raise ValueError(f"unknown quality_order {quality_order!r}")
