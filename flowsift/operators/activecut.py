"""Greedy active-timeout cuts (G3) by sparse pointer doubling, all in the JVM.

In a long segment the next cut after a cut at time t is the earliest packet (by ``pkt_idx``) whose
time is at least ``t + active``. A cut is later than every packet before it, so that packet is
the least ``pkt_idx`` over all packets of the segment with time >= t + active, whatever the order
of arrival: one suffix minimum inside the cell of width ``active`` that holds the threshold, and
one carried over from the later cells (a row for each cell).

Cuts are at least ``active`` apart, so a cell holds at most one and a block of 2^j cells is entered
at one packet. *Up*: ``step_j`` maps a packet that can enter a block of 2^j cells to the first cut
after it in another such block; ``step_{j+1}`` applies ``step_j`` at most twice and is kept only
where packets can enter the larger blocks (those in a block's first cell, and the first one after
it), so the tables halve from level to level and their sum is about twice the packets. *Down*:
from the segment's start, each level's step adds the entry of the second half-block, until each
cell has its cut. Rounds grow with the logarithm of the longest segment, not with its cuts, and
every join is on (capture, segment, packet), so no segment is gathered in a task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowsift.session import materialize

SEGMENT = ["capture_id", "seg_idx"]  # a segment's first packet names it within its capture


def successors(packets: DataFrame, active_us: int) -> DataFrame:
    """(capture_id, seg_idx, pkt_idx, cell, first_for, next_idx, next_cell): each packet's next cut if it were
    a cut. ``first_for``: the smallest cell at or after whose start this packet is the first, if any.

    ``packets``: (capture_id, seg_idx, pkt_idx, rel_us), ``rel_us`` counted from the segment's start."""
    p = packets.withColumn("cell", F.expr(f"rel_us div {int(active_us)}"))
    per_cell = p.groupBy(*SEGMENT, "cell").agg(F.min(F.struct("pkt_idx", "cell")).alias("low"))
    # suffix minima run from the end: Spark reads a frame that ends at the last row anew for each row
    order = Window.partitionBy(*SEGMENT).orderBy(F.desc("cell"))  # one row a cell
    so_far = Window.unboundedPreceding
    per_cell = materialize(per_cell.select(
        *SEGMENT, "cell", F.min("low").over(order.rowsBetween(so_far, 0)).alias("from_here"),
        F.lead("cell", 1, -1).over(order).alias("before")), "flow-cells")
    first_for = per_cell.groupBy(*SEGMENT, F.col("from_here.pkt_idx").alias("pkt_idx")).agg(
        (F.min("before") + 1).alias("first_for"))

    # a packet stands once at its own time and once, as a question, at its time plus ``active``
    # (exactly one cell further on); inside a cell the answer is a suffix minimum in time order
    both = p.select(*SEGMENT, F.explode(F.array(
        F.struct(F.col("cell").alias("cell"), F.col("rel_us").alias("at"), F.col("pkt_idx").alias("here"),
                 F.lit(None).cast("long").alias("asks")),
        F.struct((F.col("cell") + 1).alias("cell"), (F.col("rel_us") + active_us).alias("at"),
                 F.lit(None).cast("long").alias("here"), F.col("pkt_idx").alias("asks")))).alias("e")).select(*SEGMENT, "e.*")
    later = Window.partitionBy(*SEGMENT, "cell").orderBy(F.desc("at")).rangeBetween(so_far, Window.currentRow)
    asked = both.withColumn("found", F.min("here").over(later)).where("asks is not null")
    # what lies beyond the question's cell: the carry of the next cell that has packets
    carry = per_cell.select(*SEGMENT, F.explode(F.sequence(F.col("before"), F.col("cell") - 1)).alias("cell"),
                            F.col("from_here").alias("beyond"))
    asked = asked.join(carry, [*SEGMENT, "cell"], "left")
    own = F.when(F.col("found").isNotNull(), F.struct(F.col("found").alias("pkt_idx"), F.col("cell")))
    best = F.least(own, F.col("beyond"))
    asked = asked.select(*SEGMENT, F.col("asks").alias("pkt_idx"), (F.col("cell") - 1).alias("cell"),
                         best["pkt_idx"].alias("next_idx"), best["cell"].alias("next_cell"))
    return asked.join(first_for, [*SEGMENT, "pkt_idx"], "left")


def active_cuts(packets: DataFrame, n_cells: int, active_us: int) -> tuple[DataFrame, int]:
    """((capture_id, seg_idx, cut_idx), rounds): the cuts of every segment, its start not among them.

    ``packets`` must hold each segment's first packet (``pkt_idx = seg_idx``, ``rel_us`` 0) and all packets
    with ``rel_us >= active_us``; ``n_cells`` exceeds every packet's cell."""
    def block(column: str, level: int) -> F.Column:
        return F.shiftright(F.col(column), level)

    steps = [materialize(successors(packets, active_us), "flow-steps-0")]
    level = 0
    while 1 << level < n_cells:
        size = 1 << (level + 1)
        start = F.col("cell") - F.pmod(F.col("cell"), F.lit(size))
        enters = (F.col("cell") == start) | (F.col("first_for") <= start + 1)
        here = steps[level].where(enters)
        onward = steps[level].select(*SEGMENT, F.col("pkt_idx").alias("next_idx"), F.col("next_idx").alias("idx_2"),
                                     F.col("next_cell").alias("cell_2"))
        twice = block("next_cell", level + 1) == block("cell", level + 1)
        here = here.join(onward, [*SEGMENT, "next_idx"], "left").select(
            *SEGMENT, "pkt_idx", "cell", "first_for",
            F.when(twice, F.col("idx_2")).otherwise(F.col("next_idx")).alias("next_idx"),
            F.when(twice, F.col("cell_2")).otherwise(F.col("next_cell")).alias("next_cell"))
        steps.append(materialize(here, f"flow-steps-{level + 1}"))
        level += 1

    found = steps[level].where("pkt_idx = seg_idx").select(*SEGMENT, "pkt_idx", "cell")
    for j in range(level - 1, -1, -1):
        step = steps[j].select(*SEGMENT, "pkt_idx", "next_idx", "next_cell")
        inside = F.col("next_idx").isNotNull() & (block("next_cell", j + 1) == block("cell", j + 1))
        entry = F.struct("pkt_idx", "cell")
        second = F.when(inside, F.struct(F.col("next_idx").alias("pkt_idx"), F.col("next_cell").alias("cell")))
        found = found.join(step, [*SEGMENT, "pkt_idx"]).select(
            *SEGMENT, F.explode(F.filter(F.array(entry, second), lambda e: e.isNotNull())).alias("e")).select(*SEGMENT, "e.*")
        if j % 6 == 0:
            found = materialize(found, f"flow-cuts-{j}")
    return found.where("pkt_idx <> seg_idx").select(*SEGMENT, F.col("pkt_idx").alias("cut_idx")), level
