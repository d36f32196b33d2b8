"""Attach per-key values to every row of a fact table when a few keys may hold most rows.

A plain shuffle join sends all rows of one item or user to one task. Here the keys that are too
big for that are found from their exact row counts and looked up in a broadcast. Their rows, and
those without a key, then pass through the shuffle join under keys of their own that match
nothing and spread them evenly. Nothing is dropped or capped: a big key beyond the broadcast bound
only joins like the others, and its partition is left to adaptive execution to split.

The facts are named once, whatever the number of keys, so a plan grows with the statistics only.
"""

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key above HOT_ROWS rows is hot. At most HOT_KEYS hot keys are broadcast, largest first, which
# bounds the broadcast at HOT_KEYS small rows. Results do not depend on either.
HOT_ROWS = 10_000_000
HOT_KEYS = 10_000
_SPREAD = 4096


@dataclass
class KeyStats:
    """``stats`` has one row per value of ``on``, apart from any NULL, which is left out.

    ``rows`` names the number of fact rows per key, in ``stats`` or, if given, in ``sizes`` (where
    ``stats`` was computed from another table than the facts).
    """

    on: str
    stats: DataFrame
    rows: str
    sizes: DataFrame | None = None

    def hottest(self, hot_rows: int) -> DataFrame:
        sizes = self.stats if self.sizes is None else self.sizes
        big = (
            sizes.filter(F.col(self.on).isNotNull() & (F.col(self.rows) > hot_rows))
            .orderBy(F.col(self.rows).desc(), self.on)
            .limit(HOT_KEYS)
            .select(self.on)
        )
        return big.join(self.stats, self.on, "left")


def attach(facts: DataFrame, keys: Sequence[KeyStats], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join the statistics of every key to ``facts``; a NULL key matches nothing.

    The columns of ``facts`` come first, then those of each ``stats`` but its key and row count.
    Statistics shuffle on their own after their aggregation, so adaptive execution measures them,
    broadcasts them if they are small, and can split an uneven partition of the facts.
    """
    out, added = facts, []
    for number, key in enumerate(keys):
        values = [c for c in key.stats.columns if c not in (key.on, key.rows)]
        added.append(values)
        hot = key.hottest(hot_rows).select(
            F.col(key.on).alias(f"__key{number}"),
            *[F.col(f"`{c}`").alias(f"__hot{number}_{c}") for c in values],
        )
        out = out.join(F.broadcast(hot), F.col(key.on) == F.col(f"__key{number}"), "left")
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in facts.columns]), F.lit(_SPREAD))
    for number, key in enumerate(keys):
        aside = F.col(f"__key{number}").isNotNull() | F.col(key.on).isNull()
        # Salted keys have a second part above 0 and match no statistics.
        own = F.struct(key.on, F.when(aside, salt + 1).otherwise(F.lit(0)).cast("long").alias("s"))
        stats = key.stats.filter(F.col(key.on).isNotNull()).select(
            F.struct(key.on, F.lit(0).cast("long").alias("s")).alias(f"__match{number}"),
            *[F.col(f"`{c}`").alias(f"__cold{number}_{c}") for c in added[number]],
        )
        out = out.join(stats, own == F.col(f"__match{number}"), "left")
    return out.select(
        *facts.columns,
        *[
            F.when(
                F.col(f"__key{number}").isNotNull(), F.col(f"`__hot{number}_{c}`")
            ).otherwise(F.col(f"`__cold{number}_{c}`")).alias(c)
            for number, values in enumerate(added)
            for c in values
        ],
    )
