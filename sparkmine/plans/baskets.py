"""The market-basket job: baskets in, frequent itemsets and rules out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame

from sparkmine.operators import itemsets, rules
from sparkmine.operators.storage import durable


@dataclass(frozen=True)
class MarketBaskets:
    """Mining of ``items(tid, item)``, one row per distinct item of a basket."""

    items: DataFrame
    min_support: float = 0.01
    min_confidence: float = 0.7
    max_k: int | None = None
    partitions: int | None = None  # tasks that the reduced baskets are dealt over

    def __post_init__(self) -> None:
        itemsets.check_share("min_support", self.min_support)
        itemsets.check_share("min_confidence", self.min_confidence)

    @cached_property
    def _items(self) -> DataFrame:
        return durable(self.items, "items")

    @cached_property
    def n_baskets(self) -> int:
        return itemsets.basket_count(self._items)

    @cached_property
    def min_count(self) -> float:
        """The absolute support bound, a fraction that counts are compared with."""
        return self.n_baskets * self.min_support

    @cached_property
    def levels(self) -> dict[int, DataFrame]:
        return itemsets.frequent_levels(self._items, self.min_count, self.max_k, self.partitions)

    def level(self, k: int) -> DataFrame:
        """``itemset, cnt`` of size ``k``, empty if there are none."""
        return self.levels.get(k, itemsets.no_itemsets(self._items))

    @cached_property
    def itemsets(self) -> DataFrame:
        """``k, itemset, cnt, support``."""
        return itemsets.itemset_table(self.levels, self.n_baskets, self._items)

    def candidates(self, k: int) -> DataFrame:
        """Candidates of size ``k`` > 2 that survive the subset test."""
        return itemsets.pruned_candidates(self.level(k - 1), k)

    @cached_property
    def rules(self) -> DataFrame:
        """``antecedent, consequent, support_cnt, support, confidence, lift``."""
        longest = max(self.levels, default=0)
        return rules.association_rules(self.itemsets, self.n_baskets, self.min_confidence, longest)
