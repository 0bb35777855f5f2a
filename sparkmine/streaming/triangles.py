"""Triangle estimate over an unbounded edge stream.

The reservoir and the totals are small tables kept per micro-batch. A batch reads the state of the batch
before it, joins its new edges with the reservoir, and writes its own state under its batch id. A batch
that runs again after a failure therefore gives the same result and nothing is counted twice. Only the
states of the last two batches are kept.

Positions come with the stream, or are given here: the lines of a micro-batch are numbered in order, from where the batch
before ended.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from sparkmine.operators import triangles
from sparkmine.operators.edges import canonical_edges
from sparkmine.operators.order import number_rows
from sparkmine.operators.reservoir import Run, lifetimes, sample_at
from sparkmine.operators.storage import Workspace, durable, names_below, remove
from sparkmine.sources.text import ARRIVAL_ORDER

TOTALS = "edges bigint, last_pos bigint, estimate double"
EDGES = "a bigint, b bigint"
SLOTS = "run int, size int, slot bigint, t_in bigint, a bigint, b bigint"


@dataclass(frozen=True)
class TriangleState:
    """State tables of one run below ``folder``, which all executors must reach."""

    spark: SparkSession
    folder: str
    run: Run

    def _totals(self, batch_id: int) -> str:
        return f"{self.folder}/totals/batch_id={batch_id}"

    def _slots(self, batch_id: int) -> str:
        return f"{self.folder}/slots/batch_id={batch_id}"

    def batches(self) -> list[int]:
        """Ids of the batches whose state is kept, at most three while one is being written."""
        found = names_below(self.spark, f"{self.folder}/totals")
        ids = (int(name.partition("=")[2]) for name in found if name.startswith("batch_id="))
        return sorted(i for i in ids if names_below(self.spark, self._totals(i)).count("_SUCCESS"))

    def prepare(self) -> None:
        """Write the empty state, unless a state is there already."""
        if not self.batches():
            self.spark.createDataFrame([], SLOTS).write.mode("overwrite").parquet(self._slots(-1))
            start = self.spark.createDataFrame([(0, 0, 0.0)], TOTALS)
            start.write.mode("overwrite").parquet(self._totals(-1))

    def _read(self, batch_id: int) -> DataFrame:
        return self.spark.read.schema(TOTALS).parquet(self._totals(batch_id))

    def latest(self) -> DataFrame:
        """``edges, last_pos, estimate`` after the last batch."""
        return self._read(self.batches()[-1])

    def update(self, first_arrivals: DataFrame, batch_id: int) -> None:
        """Process the edges of one batch: ``a, b, pos``, pos above those of earlier batches.

        Edges with a position already passed are repeats and are skipped.
        """
        previous = max(i for i in self.batches() if i < batch_id)
        with Workspace(self.spark):
            before = self._read(previous).first()
            fresh = first_arrivals.filter(F.col("pos") > before.last_pos)
            self._advance(fresh, batch_id, previous, before)
        self._forget(previous)

    def update_lines(self, lines: DataFrame, batch_id: int, dedupe: bool = False) -> None:
        """Process the lines of one batch of a file stream: ``u, v`` and :data:`ARRIVAL_ORDER`.

        Every line has a position, repeats and self-loops too, and positions go on from those of the batch before. With
        ``dedupe`` the edges of each batch are kept in a table, and those of earlier batches are repeats.
        """
        previous = max(i for i in self.batches() if i < batch_id)
        with Workspace(self.spark):
            before = self._read(previous).first()
            placed = durable(lines.withColumn("line_no", F.monotonically_increasing_id()), "lines")
            numbered = number_rows(placed, [*ARRIVAL_ORDER, "line_no"], "pos")
            edges = canonical_edges(numbered.withColumn("pos", F.col("pos") + before.last_pos), "u", "v", ["pos"])
            edges = edges.select("a", "b", F.col("first.pos").alias("pos"))
            if dedupe:
                seen = [self._seen(i) for i in self._seen_batches() if i < batch_id]
                if seen:
                    edges = edges.join(self.spark.read.schema(EDGES).parquet(*seen), ["a", "b"], "left_anti")
                edges = durable(edges, "fresh")
                edges.select("a", "b").write.mode("overwrite").parquet(self._seen(batch_id))
            self._advance(edges, batch_id, previous, before, before.last_pos + placed.count())
        self._forget(previous)

    def _seen(self, batch_id: int) -> str:
        return f"{self.folder}/seen/batch_id={batch_id}"

    def _seen_batches(self) -> list[int]:
        return [int(name.partition("=")[2]) for name in names_below(self.spark, f"{self.folder}/seen")]

    def _forget(self, previous: int) -> None:
        """Remove the states before that of batch ``previous``."""
        for old in self.batches():
            if old < previous:
                remove(self.spark, self._totals(old))
                remove(self.spark, self._slots(old))

    def _advance(
        self, fresh: DataFrame, batch_id: int, previous: int, before: Row, last_pos: int | None = None
    ) -> None:
        """Count new edges ``a, b, pos`` and write the state; ``last_pos`` is their greatest position unless given."""
        numbered = number_rows(fresh, ["pos"], "t").withColumn("t", F.col("t") + before.edges)
        edges = durable(numbered, "arrivals")
        carried = self.spark.read.schema(SLOTS).parquet(self._slots(previous))
        entered = lifetimes(edges, [self.run], ["a", "b"]).drop("t_out")
        by_slot = Window.partitionBy("run", "slot").orderBy("t_in")
        lives = durable(
            carried.unionByName(entered).withColumn("t_out", F.lead("t_in").over(by_slot)), "lives"
        )
        parts = triangles.weighted(triangles.contributions(edges, lives))
        gain = parts.agg(F.sum("gain")).first()[0] or 0.0
        seen, last = edges.agg(F.count(F.lit(1)), F.max("pos")).first()
        sample_at(lives).drop("t_out").write.mode("overwrite").parquet(self._slots(batch_id))
        after = (before.edges + seen, last_pos or last or before.last_pos, before.estimate + gain)
        totals = self.spark.createDataFrame([after], TOTALS)
        totals.write.mode("overwrite").parquet(self._totals(batch_id))  # written last: the commit


def first_arrivals(arrivals: DataFrame) -> DataFrame:
    """``a, b, pos`` of distinct edges, from a stream with ``u, v, pos``.

    A streaming aggregation: the state store holds one row per distinct edge. In update mode a
    repeated edge is sent again with its old position, by which :meth:`TriangleState.update` skips it.
    """
    return (
        arrivals.filter(F.col("u") != F.col("v"))
        .groupBy(F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"))
        .agg(F.min("pos").alias("pos"))
    )


def simple_arrivals(arrivals: DataFrame) -> DataFrame:
    """``a, b, pos`` of a stream ``u, v, pos`` in which no edge comes twice: nothing is remembered."""
    return arrivals.filter(F.col("u") != F.col("v")).select(
        F.least("u", "v").alias("a"), F.greatest("u", "v").alias("b"), "pos"
    )


def triangle_stream(
    arrivals: DataFrame, state: TriangleState, checkpoint: str, dedupe: bool = False
) -> DataStreamWriter:
    """A writer to start: the stream ``u, v`` is counted into ``state``.

    A stream without ``pos`` is one of :func:`sparkmine.sources.text.edge_line_stream`, whose lines are numbered as they
    come. Otherwise ``pos`` must rise from one micro-batch to the next; within a batch the order is free. A stream in which
    edges repeat needs ``dedupe``, which remembers every distinct edge; without it the memory is the
    reservoir's, however long the stream.
    """
    state.prepare()
    if "pos" not in arrivals.columns:
        update = partial(state.update_lines, dedupe=dedupe)
        return arrivals.writeStream.option("checkpointLocation", checkpoint).foreachBatch(update)
    edges = first_arrivals(arrivals) if dedupe else simple_arrivals(arrivals)
    return (
        edges.writeStream.outputMode("update" if dedupe else "append")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(state.update)
    )
