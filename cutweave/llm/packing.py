"""Packing token pieces into sequences by minimum bin slack.

A document longer than the window is cut into whole windows and a rest. Rests are known to the driver by their lengths alone:
there are fewer lengths than tokens in a window, however many documents. For the longest rest that is left, a subset-sum
dynamic program over bitsets finds the multiset of other lengths that fills the window closest; backtracking gives the count
of each length, and the pattern is used as often as the counts allow. Rests that no multiset fills to within max_slack are laid
end to end and cut at the windows' ends; the last such window is cut into powers of two, which need no padding.
"""

from __future__ import annotations

from bisect import bisect_right
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import tokens
from .common import table, written
from .wavelet import ids_crc32

WINDOW = 1024


def closest_fill(counts: dict[int, int], space: int) -> dict[int, int]:
    """The multiset of lengths, within counts, whose sum is the largest that is at most space: length -> times."""
    mask, reach, steps = (1 << (space + 1)) - 1, 1, []
    for length in sorted((x for x in counts if 0 < x <= space and counts[x] > 0), reverse=True):
        steps.append((length, reach))
        left, chunk = min(counts[length], space // length), 1
        while left:  # 1, 2, 4, ... and the remainder give every number of times up to the count
            take = min(chunk, left)
            reach |= (reach << take * length) & mask
            left, chunk = left - take, chunk * 2
        if reach >> space & 1:
            break
    target, found = reach.bit_length() - 1, {}
    for length, before in reversed(steps):
        times = 0
        while not before >> target & 1:
            target, times = target - length, times + 1
        if times:
            found[length] = times
    return found


@dataclass
class Plan:
    """Where the rest with a length and a rank among its equals goes. slots: length -> [(first rank, first sequence, in a
    sequence, offset there)] in order of rank; tail: length -> (first rank, tokens before it in the tail)."""

    window: int
    slots: dict[int, list[tuple[int, int, int, int]]] = field(default_factory=dict)
    tail: dict[int, tuple[int, int]] = field(default_factory=dict)
    tail_base: int = 0
    tail_tokens: int = 0
    sequences: int = 0

    def bounds(self) -> list[int]:
        """Ends of the sequences in the last, partial window of the tail: powers of two, largest first."""
        rest, ends = self.tail_tokens % self.window, []
        for b in range(rest.bit_length() - 1, -1, -1):
            if rest >> b & 1:
                ends.append((ends[-1] if ends else 0) + (1 << b))
        return ends

    def pieces(self, length: int, rank: int) -> list[tuple[int, int, int, int]]:
        """(start in the rest, length, sequence, offset) of each piece of a rest."""
        if length in self.tail and rank >= self.tail[length][0]:
            first, base = self.tail[length]
            at, full, out, done = base + (rank - first) * length, self.tail_tokens // self.window, [], 0
            ends = self.bounds()
            while done < length:
                w, inside = divmod(at + done, self.window)
                if w < full:
                    seq, off, room = self.tail_base + w, inside, self.window - inside
                else:
                    i = bisect_right(ends, inside)
                    low = ends[i - 1] if i else 0
                    seq, off, room = self.tail_base + full + i, inside - low, ends[i] - inside
                take = min(room, length - done)
                out.append((done, take, seq, off))
                done += take
            return out
        rows = self.slots[length]
        first, seq, each, offset = rows[bisect_right(rows, (rank, float("inf"))) - 1]
        bin_, slot = divmod(rank - first, each)
        return [(0, length, seq + bin_, offset + slot * length)]


def make_plan(histogram: dict[int, int], window: int = WINDOW, max_slack: int = 0) -> Plan:
    """histogram: length of a rest (1 to window - 1) -> how many there are."""
    plan, left, used = Plan(window), {x: n for x, n in histogram.items() if n > 0}, dict.fromkeys(histogram, 0)
    while left:
        longest = max(left)
        left[longest] -= 1
        fill = closest_fill(left, window - longest)
        left[longest] += 1
        fill[longest] = fill.get(longest, 0) + 1
        if window - sum(x * k for x, k in fill.items()) > max_slack:  # no fill for this length now, so for none of its copies later
            plan.tail[longest] = (used[longest], plan.tail_tokens)
            plan.tail_tokens += longest * left.pop(longest)
            continue
        times, offset = min(left[x] // k for x, k in fill.items()), 0
        for x, k in sorted(fill.items(), reverse=True):
            plan.slots.setdefault(x, []).append((used[x], plan.sequences, k, offset))
            offset += x * k
            used[x] += k * times
            left[x] -= k * times
            if not left[x]:
                del left[x]
        plan.sequences += times
    plan.tail_base = plan.sequences
    plan.sequences += plan.tail_tokens // window + len(plan.bounds())
    return plan


def pack(docs: DataFrame, window: int = WINDOW, tokenizer: str | None = None, end_id: int = 0, max_slack: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (little-endian 16-bit).

    Each row of docs is a document, repeated rows and ids included; a NULL text is empty and has its end id alone; the order
    of documents in sequences is not defined; an empty table gives no rows. With max_slack 0 only powers of two stay below
    the window.
    """
    path = tokenizer or tokens.tokenizer_path()
    id_type = docs.schema[id_col].dataType.simpleString()
    id_arrow = docs.select(F.col(id_col).alias("doc_id")).limit(0).toArrow().schema.field("doc_id").type
    end = np.array([end_id], "<u2").tobytes()

    def encode(batches):
        encoder, part = tokens.encoder(path), TaskContext.get().partitionId()
        ranks, whole = np.zeros(window, np.int64), 0
        for batch in batches:
            ids, texts = batch.column(0), [t or "" for t in batch.column(1).to_pylist()]
            for some in tokens.in_pieces(texts, [len(t) for t in texts], 1 << 20):
                data = [b + end for b in encoder.encode(texts[some])]
                rank, before, rests = [], [], [len(b) // 2 % window for b in data]
                for b, rest in zip(data, rests, strict=True):
                    rank.append(int(ranks[rest]))
                    ranks[rest] += 1
                    before.append(whole)
                    whole += len(b) // 2 // window
                yield pa.RecordBatch.from_arrays([pa.array([part] * len(data), pa.int32()), ids[some.start : some.stop], pa.array(rests, pa.int32()), pa.array(rank, pa.int64()), pa.array(before, pa.int64()), pa.array([len(b) // 2 // window for b in data], pa.int64()), pa.array(data, pa.binary())], ["part", "doc_id", "rest", "rank", "before", "whole", "ids"])

    rows = written(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(encode, f"part int, doc_id {id_type}, rest int, rank long, before long, whole long, ids binary"), "encoded")
    counts = written(rows.groupBy("part", "rest").agg(F.count("*").alias("n"), F.sum("whole").alias("whole")), "rests")
    histogram = {r["rest"]: r["n"] for r in counts.groupBy("rest").agg(F.sum("n").alias("n")).collect()}  # at most one row for each length
    histogram.pop(0, None)
    plan = make_plan(histogram, window, max_slack)
    of_part = counts.groupBy("part").agg(F.sum("whole").alias("w"))  # a row for each partition
    firsts = of_part.select("part", (F.sum("w").over(Window.orderBy("part")) - F.col("w")).alias("first_whole"))
    shift = counts.select("part", "rest", (F.sum("n").over(Window.partitionBy("rest").orderBy("part")) - F.col("n")).alias("first_rank")).join(firsts, "part")

    def place(batches):
        for batch in batches:
            out: list[tuple] = []
            doc = []
            for i, (rest, rank, before, data) in enumerate(zip(*(batch.column(n).to_pylist() for n in ("rest", "rank", "before", "ids")), strict=True)):
                ids = np.frombuffer(data, "<u2")
                full = len(ids) // window
                parts = [(w * window, window, plan.sequences + before + w, 0) for w in range(full)]
                parts += [(full * window + s, n, q, o) for s, n, q, o in (plan.pieces(rest, rank) if rest else ())]
                doc += [i] * len(parts)
                out += [(s, n, ids_crc32(ids[s : s + n]), len(ids), q, o, ids[s : s + n].tobytes()) for s, n, q, o in parts]
            if out:
                cols = [pa.array(c, pa.binary() if j == 6 else pa.int64()) for j, c in enumerate(zip(*out, strict=True))]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(doc)).cast(id_arrow), *cols], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    located = rows.join(shift, ["part", "rest"]).select("doc_id", "rest", (F.col("rank") + F.col("first_rank")).alias("rank"), (F.col("before") + F.col("first_whole")).alias("before"), "ids")
    return located.mapInArrow(place, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")


def op3_packing(spark, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents")).drop("ids")
