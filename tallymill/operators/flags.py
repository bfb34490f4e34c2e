"""Yes/no features: present-versus-absent comparison in a tidy table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .summaries import COUNT, level_counts, summarize

FEATURE = "Feature"
PRESENT = "Feature_Present"


def _order() -> list:
    return [FEATURE, F.desc(PRESENT)]


MASK = "Feature_Mask"
WORD = 62  # flags a whole number holds


def mask_words(flags: Sequence[str]) -> dict[str, Sequence[str]]:
    """The flags of each mask column: one for up to 62 of them, else numbered ones."""
    parts = [flags[i : i + WORD] for i in range(0, len(flags), WORD)] or [flags]
    return {MASK if i == 0 else f"{MASK}_{i + 1}": part for i, part in enumerate(parts)}


def flag_mask(flags: Sequence[str]) -> Column:
    """Up to 62 flags packed into one whole number, bit i for flag i; null reads as false."""
    if len(flags) > WORD:
        raise ValueError(f"one mask holds {WORD} flags; mask_words says which column holds which")
    if not flags:
        return F.lit(0).cast("bigint")
    bits = [
        F.when(F.col(f"`{name}`"), F.lit(1 << i)).otherwise(F.lit(0)).cast("bigint")
        for i, name in enumerate(flags)
    ]
    return reduce(lambda a, b: a + b, bits)


def flag_counts(frame: DataFrame, flags: Sequence[str], level: str = "Severity") -> DataFrame:
    """Rows per flag combination and level: the mask columns, level, count."""
    words = mask_words(flags)
    masked = frame.select(*[flag_mask(part).alias(name) for name, part in words.items()], level)
    return level_counts(masked, list(words), level)


def flag_summary(
    counts: DataFrame,
    flags: Sequence[str],
    *,
    mean: Mapping[str, str | Column] | None = None,
    rate: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Feature, Feature_Present and the measures, from ``flag_counts``.

    The combinations are unpivoted, not the rows, so the big table is read once
    and not multiplied by the number of flags.  A value that never occurs has no
    row.
    """
    pairs = [
        F.struct(
            F.lit(name).alias(FEATURE),
            (F.col(word).bitwiseAND(F.lit(1 << i)) != 0).alias(PRESENT),
        )
        for word, part in mask_words(flags).items()
        for i, name in enumerate(part)
    ]
    tidy = counts.select("*", F.inline(F.array(*pairs)))
    return summarize(
        tidy, [FEATURE, PRESENT], mean=mean, rate=rate, weight=COUNT, order=_order()
    )


def flag_summary_unpivot(
    frame: DataFrame,
    flags: Sequence[str],
    *,
    keep: Sequence[str] = ("Severity",),
    mean: Mapping[str, str | Column] | None = None,
    rate: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The same table by unpivoting the rows: any measure, any number of flags."""
    filled = frame.select(*keep, *[F.coalesce(F.col(f), F.lit(False)).alias(f) for f in flags])
    tidy = filled.unpivot(list(keep), list(flags), FEATURE, PRESENT)
    return summarize(tidy, [FEATURE, PRESENT], mean=mean, rate=rate, order=_order())


def flag_summary_union(
    frame: DataFrame,
    flags: Sequence[str],
    *,
    mean: Mapping[str, str | Column] | None = None,
    rate: Mapping[str, Column] | None = None,
) -> DataFrame:
    """The same table as one aggregate per flag, united by column name.

    Its aggregates run over the counted flag combinations, so the rows are read once.
    """
    counts = flag_counts(frame, flags)
    tidy = {
        name: counts.select("*", (F.col(word).bitwiseAND(F.lit(1 << i)) != 0).alias(PRESENT))
        for word, part in mask_words(flags).items()
        for i, name in enumerate(part)
    }
    parts = [
        summarize(
            tidy[name],
            [PRESENT],
            mean=mean,
            rate=rate,
            weight=COUNT,
        ).select(F.lit(name).alias(FEATURE), "*")
        for name in flags
    ]
    return reduce(DataFrame.unionByName, parts).orderBy(*_order())
