"""The near-duplicate job: texts in, similar pairs and their quality out."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkmine.functions.sets import signature_similarity
from sparkmine.operators import lsh, quality
from sparkmine.operators.documents import (
    beside_pairs,
    copy_groups,
    group_members,
    group_texts,
    normalized_documents,
    set_statistics,
    with_copies,
)
from sparkmine.operators.jaccard_join import check_threshold, shingle_frequencies, similar_pairs, verify
from sparkmine.operators.skew import lookup_semi
from sparkmine.operators.storage import durable, release


@dataclass(frozen=True)
class NearDuplicates:
    """Near-duplicate detection over ``docs``.

    Results are pairs of *groups* of equal texts, named by their smallest document id and weighted by
    ``copies1`` and ``copies2``; :attr:`members` maps every document to its group.
    """

    docs: DataFrame
    id_col: str = "doc_id"
    text_col: str = "text"
    k: int = 10
    n: int = 100
    threshold: float = 0.8
    empties: str = "match"
    crc_bands: bool = False
    block_rows: int | None = None  # rows of a bucket that one task pairs with as many others

    def __post_init__(self) -> None:
        check_threshold(self.threshold)

    @cached_property
    def normalized(self) -> DataFrame:
        """``doc_id, normalized, text_key`` for every document."""
        return normalized_documents(self.docs, self.k, self.id_col, self.text_col, self.empties)

    @cached_property
    def _normalized(self) -> DataFrame:
        return durable(self.normalized, "normalized")

    @cached_property
    def _keys(self) -> DataFrame:
        """``doc_id, text_key``, which outlive the texts of all documents."""
        return durable(self._normalized.select("doc_id", "text_key"), "keys")

    @cached_property
    def groups(self) -> DataFrame:
        return durable(copy_groups(self._keys), "groups")

    @cached_property
    def texts(self) -> DataFrame:
        """``group_id, normalized``, one row per group. The texts of all documents go, unless a frame reads them."""
        groups = self.groups
        texts = durable(group_texts(self._normalized, groups), "texts")
        if not {"statistics", "frequencies"} & self.__dict__.keys():
            release(self.__dict__.pop("_normalized"))
        return texts

    @cached_property
    def members(self) -> DataFrame:
        """``doc_id, group_id, copies``."""
        return group_members(self._keys, self.groups)

    @cached_property
    def statistics(self) -> DataFrame:
        """``doc_id, n_chars, n_shingles, min_hash, max_hash, sum_hash`` of every document's shingle set."""
        return set_statistics(self._normalized, self.k)

    @cached_property
    def frequencies(self) -> DataFrame:
        """``shingle, docs``."""
        return shingle_frequencies(self._normalized, self.k)

    @cached_property
    def signatures(self) -> DataFrame:
        """``doc_id, signature`` for every document."""
        return lsh.signatures(self.normalized, self.k, self.n).select("doc_id", "signature")

    @cached_property
    def banded(self) -> DataFrame:
        banded = lsh.banded_groups(
            self.texts, self.groups, self.k, self.n, self.threshold, self.crc_bands
        )
        return durable(banded, "banded")

    @cached_property
    def band_rows(self) -> DataFrame:
        return lsh.band_rows(self.banded)

    @cached_property
    def candidates(self) -> DataFrame:
        """``id1, id2``: pairs of groups that share a bucket."""
        return durable(lsh.candidate_pairs(self.band_rows, self.block_rows), "candidates")

    @cached_property
    def verified(self) -> DataFrame:
        """Every candidate with its exact similarity and ``is_similar``, for judging the candidates."""
        checked = verify(self.candidates, self.texts, self.k)
        return with_copies(quality.label(checked, self.threshold), self.banded)

    @cached_property
    def similar(self) -> DataFrame:
        """The job's result: candidates that are similar."""
        checked = verify(self.candidates, self.texts, self.k, self.threshold)
        found = checked.filter(F.col("jaccard") >= self.threshold)
        return with_copies(found, self.banded)

    @cached_property
    def true_pairs(self) -> DataFrame:
        """Every similar pair of groups, by the exact join."""
        return with_copies(similar_pairs(self.texts, self.k, self.threshold), self.groups)

    @cached_property
    def missed(self) -> DataFrame:
        """Similar pairs that are no candidates."""
        true = durable(self.true_pairs, "true")
        found = lsh.sharing_a_band(true, self.banded)
        return true.join(found.select("id1", "id2"), ["id1", "id2"], "left_anti")

    @cached_property
    def quality(self) -> DataFrame:
        """One row: true and false positives, false negatives, recall, precision."""
        candidates = lsh.candidate_totals(self.band_rows, self.block_rows)
        return quality.quality(self.banded, self.similar, candidates, self.missed)

    def estimated(self) -> DataFrame:
        """Candidates with the similarity estimated from signatures, ``id1, id2, estimate``."""
        ids = durable(self.candidates.select(F.explode(F.array("id1", "id2")).alias("group_id")).distinct(), "ids")
        signed = durable(lsh.signatures(lookup_semi(self.texts, ids, ["group_id"]), self.k, self.n), "signed")
        both = beside_pairs(self.candidates, signed, "signature")
        return both.select(
            "id1", "id2", signature_similarity(F.col("signature1"), F.col("signature2")).alias("estimate")
        )
