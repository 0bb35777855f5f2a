"""URL rules decided by a cascade of Bloom filters, exact for the keys of one corpus.

Level 1 holds the listed keys. Level 2 holds the unlisted keys of the corpus that pass level 1 by
mistake, level 3 the listed ones that pass level 2, and so on until nothing passes wrongly. A key is
listed if the first level that stops it has an even number (Larisch et al. 2017). The levels travel as
constants of the query, so judging needs no join. A list too long for constants is joined on the key instead.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkmine.llm.tables import Scratch
from sparkmine.operators.skew import lookup_join

MAX_KEYS = 500_000  # listed keys in constants: 2 MB of bits; more are joined


@dataclass(frozen=True)
class Rule:
    """``verdict`` for hosts that are ``host`` or below it and paths that begin with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def key(self) -> str:
        return self.host + self.path


def with_parts(pages: DataFrame) -> DataFrame:
    """Add ``host`` and ``path`` of ``url``; both empty without ``://`` or for a null url."""
    url = F.coalesce(F.col("url"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    capitals = "".join(map(chr, range(65, 91)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), capitals, capitals.lower())
    return pages.withColumns({"host": host, "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def shapes(rules: Sequence[Rule]) -> list[tuple[int, int]]:
    """(labels of the host, length of the path) of all rules."""
    return sorted({(r.host.count(".") + 1, len(r.path)) for r in rules})


def candidate(shape: tuple[int, int]) -> Column:
    """The key that a rule of this shape must have to fit a row; null if none can."""
    labels, length = shape
    host = F.substring_index("host", ".", -labels)
    whole = F.length("host") - F.length(F.replace(F.col("host"), F.lit("."), F.lit(""))) + 1
    fits = (F.length("path") >= length) & (whole >= labels) & (F.col("host") != "")
    return F.when(fits, F.concat(host, F.substring("path", 1, length)))


def _slots(key: Column, level: int, bits: int, probes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(key, F.lit(level * 64 + i)), F.lit(bits)) for i in range(probes)]


@dataclass(frozen=True)
class Level:
    number: int
    bits: int
    probes: int
    words: tuple[int, ...]

    def holds(self, key: Column) -> Column:
        """Whether all of the key's bits are set."""
        table = F.lit(list(self.words)).cast("array<bigint>")

        def bit(slot: Column) -> Column:
            word = F.get(table, F.shiftright(slot, 6).cast("int"))
            return F.call_function("shiftright", word, slot.bitwiseAND(63).cast("int")).bitwiseAND(1) == 1

        return reduce(Column.__and__, [bit(s) for s in _slots(key, self.number, self.bits, self.probes)])


def _keys_frame(spark: SparkSession, keys: Sequence[str]) -> DataFrame:
    values = F.array(*[F.lit(k) for k in keys]) if keys else F.expr("cast(array() as array<string>)")
    return spark.range(1).select(F.explode(values).alias("key"))


def bloom_level(keys: DataFrame, count: int, number: int, rate: float) -> Level:
    """A filter of ``keys(key)``; the bits are set by Spark, one row per 64 bits comes back."""
    probes = max(1, round(-math.log2(rate)))
    bits = max(64, math.ceil(count * -math.log(rate) / math.log(2) ** 2 / 64) * 64)
    slot = F.explode(F.array(*_slots(F.col("key"), number, bits, probes))).alias("slot")
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("slot").bitwiseAND(63).cast("int"))
    word = F.shiftright("slot", 6).alias("word")
    rows = keys.select(slot).groupBy(word).agg(F.bit_or(bit).alias("bits")).collect()
    words = [0] * (bits // 64)
    for row in rows:
        words[row.word] = row.bits
    return Level(number, bits, probes, tuple(words))


@dataclass(frozen=True)
class Cascade:
    levels: tuple[Level, ...]

    def lists(self, key: Column) -> Column:
        """Whether ``key``, any key of the corpus or listed, is listed."""
        answer: Column = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(self.levels):
            answer = F.when(level.holds(key), answer).otherwise(F.lit(level.number % 2 == 0))
        return F.coalesce(answer, F.lit(False))


def cascade(universe: DataFrame, listed: Sequence[str]) -> Cascade:
    """Levels that tell ``listed`` from every other key of ``universe(key)``.

    The first level lets about as many unlisted keys pass as there are listed ones, the others half of
    what they see, so the keys that come back to the driver are a small multiple of the list.
    """
    listed = sorted(set(listed))
    if len(listed) > MAX_KEYS:
        raise ValueError(f"a cascade takes at most {MAX_KEYS} listed keys; judge() joins longer lists")
    if not listed:
        return Cascade(())
    spark = universe.sparkSession
    known = F.col("key").isin(list(listed))
    others = universe.filter(~known).agg(F.approx_count_distinct("key")).first()[0]
    levels = [bloom_level(_keys_frame(spark, listed), len(listed), 1, min(0.5, len(listed) / max(others, 1)))]
    passing, inside = universe.filter(~known), listed
    wrong = [r.key for r in passing.filter(levels[0].holds(F.col("key"))).distinct().collect()]
    while wrong:
        number = len(levels) + 1
        levels.append(bloom_level(_keys_frame(spark, wrong), len(wrong), number, 0.5))
        rest = _keys_frame(spark, inside).filter(levels[-1].holds(F.col("key")))
        inside, wrong = wrong, sorted(r.key for r in rest.collect())
    return Cascade(tuple(levels))


def judge(pages: DataFrame, rules: Sequence[Rule], default: str = "allow") -> DataFrame:
    """Add ``host, path, rule, verdict`` to ``pages(url)``.

    The longest rule that fits wins (of equally long ones, that with the longer host); without any,
    ``rule`` is null and ``verdict`` is ``default``. Null and malformed urls fit no rule; repeated rows are
    judged one by one. Columns of ``pages`` that have one of the new names are replaced.
    """
    verdicts = sorted({r.verdict for r in rules})
    if len({r.key: r.verdict for r in rules}) != len({(r.key, r.verdict) for r in rules}):
        raise ValueError("two rules with one key must agree")
    parts = with_parts(pages)
    keys = {shape: candidate(shape) for shape in shapes(rules)}
    if len({r.key for r in rules}) > MAX_KEYS:
        return _judged_by_join(parts, rules, keys, default)
    exploded = parts.select(F.explode(F.array(*keys.values())).alias("key")) if keys else None
    rule: Column = F.lit(None).cast("string")
    verdict: Column = F.lit(default)
    if exploded is not None:
        universe = exploded.filter("key is not null").distinct()
        made = {v: cascade(universe, [r.key for r in rules if r.verdict == v]) for v in verdicts}
        found = []
        for shape, key in keys.items():
            held = [r for r in rules if (r.host.count(".") + 1, len(r.path)) == shape]
            for v in sorted({r.verdict for r in held}):
                fits = made[v].lists(key)
                size = F.length(key).alias("n")
                rated = F.struct(size, F.lit(shape[0]).alias("labels"), key.alias("key"), F.lit(v).alias("verdict"))
                found.append(F.when(fits, rated))
        best = F.array_max(F.array(*found))
        rule, verdict = best["key"], F.coalesce(best["verdict"], F.lit(default))
    return parts.withColumn("rule", rule).withColumn("verdict", verdict)


def _judged_by_join(
    parts: DataFrame, rules: Sequence[Rule], keys: dict[tuple[int, int], Column], default: str
) -> DataFrame:
    """:func:`judge` for more rules than a plan can hold; a key that most pages have is salted."""
    spark, scratch = parts.sparkSession, Scratch(parts.sparkSession)
    row, number = "row", 0
    while any(c.lower() == row for c in parts.columns):
        row, number = f"row_{number}", number + 1
    rows = scratch.write("rows", parts.withColumn(row, F.monotonically_increasing_id()))
    tried = F.array(*[F.struct(key.alias("key"), F.lit(shape[0]).alias("labels")) for shape, key in keys.items()])
    asked = rows.select(row, F.explode(tried).alias("t")).select(row, "t.key", "t.labels").dropna(subset=["key"])
    listed = spark.createDataFrame([(r.key, r.host.count(".") + 1, r.verdict) for r in rules], "key string, labels int, verdict string")
    listed = scratch.write("listed", listed.distinct())
    rated = F.struct(F.length("key").alias("n"), "labels", "key", "verdict")
    best = lookup_join(asked, listed, ["key", "labels"]).groupBy(row).agg(F.max(rated).alias("best"))
    best = best.select(row, F.col("best.key").alias("rule"), F.col("best.verdict").alias("verdict"))
    kept = [c for c in rows.columns if c.lower() not in ("rule", "verdict")]
    judged = rows.select(*kept).join(best, row, "left").drop(row)
    return judged.withColumn("verdict", F.coalesce("verdict", F.lit(default)))
