"""Training samples, group-level splits and their audits."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmill.functions.text import sentences
from quillmill.functions.udfs import pack_udf


def samples(df: DataFrame, key: str, text: str, least: int = 500, goal: int = 2500, most: int = 3500) -> DataFrame:
    """``sample_id, key, sample``: packed sentences of each text; NULL and short texts give none."""
    packed = df.where(F.col(text).isNotNull()).select(key, F.posexplode(pack_udf(least, goal, most)(sentences(F.col(text)))).alias("n", "sample"))
    return packed.select(F.concat(F.col(key).cast("string"), F.format_string("_sample_%04d", F.col("n") + 1)).alias("sample_id"), key, "sample")


def section_samples(sections: DataFrame, whole: DataFrame, key: str, text: str, **sizes) -> DataFrame:
    """Samples from sections, and from the whole text where no section gave one."""
    by_section = samples(sections, key, text, **sizes).withColumn("mode", F.lit("SECTION"))
    rest = whole.join(by_section.select(key).distinct(), key, "left_anti")
    return by_section.unionByName(samples(rest, key, text, **sizes).withColumn("mode", F.lit("FALLBACK_FULL_TEXT")))


#: Sections of a paper that samples are made from.
TRAINABLE = ("introduction", "literature_review", "methodology", "results", "discussion", "conclusion")


def usable_sections(sections: DataFrame, section: str = "section", content: str = "content") -> DataFrame:
    return sections.where(F.col(section).isin(*TRAINABLE) & (F.trim(content) != ""))


def hashed_split(key: Column, share: float = 0.15, seed: int = 42) -> Column:
    """``validation`` for about ``share`` of the keys, by the first figures of a seeded digest; no shuffle, stable under growth."""
    digest = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key)), 1, 8), 16, 10).cast("bigint")
    return F.when(digest < int(share * (1 << 32)), "validation").otherwise("train")


def shuffled_split(keys: list[str], share: float = 0.15, seed: int = 42) -> dict[str, str]:
    """Exactly ``round(share * n)`` keys (one at least) in validation, from a seeded shuffle of a small sorted list."""
    order = sorted(keys)
    random.Random(seed).shuffle(order)
    held = set(order[: max(1, round(share * len(order)))])
    return {k: "validation" if k in held else "train" for k in keys}


def leaked(train: DataFrame, other: DataFrame, key: str) -> DataFrame:
    return train.select(key).intersect(other.select(key))
