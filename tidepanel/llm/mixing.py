"""Mixing sources to target weights as a Pfair schedule.

Each source is cut in blocks of documents, and the mixture in frames of as many blocks. After
``t`` blocks a source of weight ``w`` has given ``floor(w t)`` or ``ceil(w t)`` of its own at each
end of a frame: those whose next block would be due first are ahead. Weights are not rounded to
the frame, so the frames of a source differ. Within a frame, with ``q`` of its ``L`` blocks, block
``j`` of a source is released at slot ``floor(j L / q)`` and due at ``ceil((j + 1) L / q)``. Each slot takes
the released block with the earliest deadline. The shares of a frame add up to one, so all
deadlines are met: a source is less than one block from its target share at the end of a frame
and less than two at any slot, however many frames there are.

When a source has run out, that frame is shorter, and from its end the weights of the others
count in proportion.

The driver settles how many blocks each source gives to each frame, a row per source and frame
at most; the frames are scheduled on Spark. All numbers are whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import small_table
from tidepanel.session import materialise

#: Blocks of a frame.
PARTS = 200
#: Documents of a block.
BLOCK = 8
#: Rows of a source that one task numbers, about.
RUN = 4_000
#: Frames that one task schedules, about.
FRAMES = 16
#: Weights are whole multiples of the sum's share by this.
UNIT = 1 << 30


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a.cast("long"), b.cast("long"))


def _source() -> Column:
    """The source as a key: null is a source of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))


def placed(docs: DataFrame, plan: DataFrame, block: int) -> DataFrame:
    """(row, place, spot): each row of ``docs`` as a struct, its number in the source by the md5 of
    its id, and the place of its block in the mixture. A source is dealt over many runs by the
    first digits of that order, and the sizes of earlier runs are added to the number in a run."""
    rows = docs.select(F.struct("*").alias("row"), _source().alias("mix_source"),
                       F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("order"))
    runs = max(1, docs.select("doc_id").count() // RUN)
    digits = F.conv(F.substring("order", 1, 7), 16, 10).cast("long")
    rows = rows.withColumn("run", _div(digits * runs, F.lit(1 << 28)))
    sizes = rows.groupBy("mix_source", "run").agg(F.count("*").alias("n"))
    before = Window.partitionBy("mix_source").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("mix_source", "run", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    at = lambda x: _div(x, F.lit(block))
    blocks = F.sequence(at(F.col("first")), at(F.col("first") + F.col("n") - 1))
    spots = (first.select("mix_source", "run", "first", F.explode(blocks).alias("block"))
             .join(plan, ["mix_source", "block"]).groupBy("mix_source", "run").agg(
                 F.first("first").alias("first"),
                 F.array_sort(F.collect_list(F.struct("block", "release", "deadline", "slot"))).alias("spots")))
    own = Window.partitionBy("mix_source", "run").orderBy("order", "row.doc_id", F.xxhash64("row"))
    rows = rows.withColumn("rank", F.row_number().over(own)).join(spots, ["mix_source", "run"])
    place = F.col("first") + F.col("rank") - 1
    return rows.select("row", place.alias("place"),
                       F.get("spots", (at(place) - at(F.col("first"))).cast("int")).alias("spot"))


def shares(docs: DataFrame, weights: dict[str, float] | None = None, block: int = BLOCK) -> DataFrame:
    """(mix_source, blocks, w) of every source. Without ``weights`` a source weighs the
    square root of its size; sources that ``weights`` leaves out get its least weight."""
    sizes = docs.groupBy(_source().alias("mix_source")).agg(F.count("*").alias("rows"))
    if weights:
        if min(weights.values()) <= 0:
            raise ValueError("weights must be positive")
        named = small_table(docs.sparkSession, [{"k": "=" + s, "w": float(w)} for s, w in weights.items()],
                            "k string, w double")
        sizes = (sizes.join(named, F.col("mix_source") == F.col("k"), "left")
                 .withColumn("w", F.coalesce("w", F.lit(float(min(weights.values()))))))
    else:
        sizes = sizes.withColumn("w", F.sqrt(F.col("rows").cast("double")))
    return sizes.select("mix_source", _div(F.col("rows") + block - 1, F.lit(block)).alias("blocks"), "w")


def dealt(blocks: np.ndarray, w: np.ndarray, parts: int) -> np.ndarray:
    """(frame, source, first, q, size, start) in columns: in a frame of ``size`` blocks from slot
    ``start`` a source gives ``q`` blocks from ``first`` on.

    The blocks that lie within a frame by their windows are never more than its slots, so
    there are as many sources to be ahead as the frame needs.
    """
    out, frame, start = [], 0, 0
    at, left = np.arange(len(blocks)), blocks.astype(np.int64)
    while len(at):
        unit = np.maximum(1, np.rint(w[at] / w[at].sum() * UNIT)).astype(np.int64)
        every, t = int(unit.sum()), 0
        given = np.zeros(len(at), np.int64)
        while left.all():
            t += parts
            upto = np.maximum(unit * t // every, given)
            behind = np.flatnonzero(upto * every < unit * t)
            due = ((upto[behind] + 1) * every + unit[behind] - 1) // unit[behind]
            upto[behind[np.argsort(due, kind="stable")[:t - int(upto.sum())]]] += 1
            q = np.minimum(upto - given, left)
            some, size = np.flatnonzero(q), int(q.sum())
            whole = np.full(len(some), 1, np.int64)
            out.append(np.stack([whole * frame, at[some], blocks[at[some]] - left[some], q[some],
                                 whole * size, whole * start]))
            left, given, frame, start = left - q, upto, frame + 1, start + size
        at, left = at[left > 0], left[left > 0]
    return np.concatenate(out, axis=1) if out else np.zeros((6, 0), np.int64)


def frames(share: DataFrame, parts: int) -> DataFrame:
    """``dealt`` as a table with ``mix_source``."""
    held = share.toArrow().sort_by("mix_source")
    columns = dealt(held["blocks"].to_numpy(), held["w"].to_numpy(), parts)
    names = held["mix_source"].combine_chunks().take(pa.array(columns[1]))
    table = pa.table([names, *[pa.array(columns[i]) for i in (0, 2, 3, 4, 5)]],
                     names=["mix_source", "frame", "first", "q", "size", "start"])
    tasks = 1 + int(columns[0].max(initial=0)) // FRAMES
    return share.sparkSession.createDataFrame(table).repartition(tasks, "frame")


def frame_schedules(frame: DataFrame) -> DataFrame:
    """(mix_source, block, release, deadline, slot) of the blocks of all frames: earliest deadline
    first among the released of a frame."""
    j = F.explode(F.sequence(F.lit(0).cast("long"), F.col("q") - 1)).alias("j")
    blocks = frame.select("frame", "start", "mix_source", "first", "q", "size", j).select(
        "frame", "start", F.struct(
            _div((F.col("j") + 1) * F.col("size") + F.col("q") - 1, F.col("q")).alias("deadline"),
            "mix_source", (F.col("first") + F.col("j")).alias("block"),
            _div(F.col("j") * F.col("size"), F.col("q")).alias("release")).alias("b"))
    frames = blocks.groupBy("frame", "start").agg(F.array_sort(F.collect_list("b")).alias("open"))
    struct = blocks.schema["b"].dataType.simpleString()
    first = F.struct(F.col("open"), F.array().cast(f"array<struct<slot:int,b:{struct}>>").alias("out"))

    def place(acc: Column, slot: Column) -> Column:
        """Moves the first released block; those still open are in order of deadline."""
        b = F.get(F.filter(acc["open"], lambda x: x["release"] <= slot), 0)
        return F.struct(F.array_except(acc["open"], F.array(b)).alias("open"),
                        F.concat(acc["out"], F.array(F.struct(slot.alias("slot"), b.alias("b")))).alias("out"))

    slots = F.sequence(F.lit(0), F.size("open") - 1)
    rows = frames.select("start", F.explode(F.aggregate(slots, first, place, lambda a: a["out"])).alias("x"))
    at = lambda c: (F.col("start") + F.col(c)).alias(c.split(".")[-1])
    return rows.select("x.b.mix_source", "x.b.block", at("x.b.release"), at("x.b.deadline"), at("x.slot"))


def mix(docs: DataFrame, weights: dict[str, float] | None = None, parts: int = PARTS,
        block: int = BLOCK) -> DataFrame:
    """Every row of ``docs`` with ``block`` (its number in the source), ``release``,
    ``deadline`` and ``slot`` of the block, and ``position`` in the mixture.

    Rows within a source follow the md5 of their id, so the order is random but fixed;
    ``position`` counts as if every block were full. A null source is a source, rows with a
    null id come in a fixed order too, repeated rows are placed each, an empty table gives no
    rows. Columns of those five names are replaced, other columns stay. There may be more
    sources than ``parts``, the blocks of a frame.
    """
    docs = docs.drop("block", "release", "deadline", "slot", "position")
    plan = materialise(frame_schedules(frames(shares(docs.select("source"), weights, block), parts)), "frames")
    return placed(docs, plan, block).select(
        "row.*", *[F.col("spot")[c].alias(c) for c in ("block", "release", "deadline", "slot")],
        (F.col("spot")["slot"] * block + F.col("place") % block).alias("position"))
