"""Trie of conversation prefixes, built as a burst trie.

A turn is known by a 128-bit digest of its role and text and by its length,
so texts are read once and never shuffled. A conversation is a sequence of
turn digests, cut into segments of ``SEGMENT`` turns; every segment hangs in
a container under a trie head (the root, or the digest of all turns before
the segment). Then

* a container of more than ``CONTAINER`` turns is burst: its suffixes' common
  path becomes a chain of nodes and each next turn a head with a container of
  its own. Members of a head are counted before the shuffle; rounds go on
  until no container is too large. A head may have any number of children,
  they are rows;
* every remaining container is sorted by its suffixes (in Spark, spilling)
  and swept once: the shared length with the suffix before tells which nodes
  are new. A task holds the nodes of one container, ``CONTAINER`` turns at
  most;
* heads give their totals (children, leaves, saved tokens, digest of members
  that end there) to the container above, deepest heads first.

Digests of members are streams over sorted ids, so a node where a third of
all conversations end needs no list in memory. Rounds number the largest
count of over-full heads on one path; each is a staged table in the shared
folder, so a lost executor repeats part of a round.

Rows without a conversation id belong to no conversation. A null role or
text is empty, a null turn comes first; equal turn numbers are ordered by
the turn's digest, and repeated rows are repeated turns. Very long texts
count by their code points. No conversations: no nodes, not even a root.
Further columns are ignored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plover.llm.common import map_batches, stage
from plover.operators.joins import rekeyed
from plover.operators.scan import running_count

SEGMENT = 1024  # turns of a conversation in one row
CONTAINER = 1 << 14  # turns that are swept together
TURN_BUCKET = 1024  # turn numbers whose rows are ordered together
NOTHING = hashlib.sha256(b"").hexdigest()
NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
        "saved_tokens long, ends_sha256 string")


def turn_rows(conversations: DataFrame) -> DataFrame:
    """conv_id, pos (from 1), turn_id binary and size of every turn. Ordered by
    (conversation, bucket of turn numbers), so one conversation may be very long."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    t = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))).alias("turn_id"),
        F.char_length(text).cast("long").alias("size"))
    t = stage(t, "trie-turns")
    out = running_count(t, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("turn_id")], F.lit(1),
                        F.coalesce(F.floor(F.col("turn") / TURN_BUCKET).cast("long"), F.lit(-(1 << 62))), "pos")
    return out.select("conv_id", "pos", "turn_id", "size")


def _head_digest(head, ids):
    return F.md5(F.concat(head, F.lit("|"), F.array_join(F.transform(ids, F.hex), "")))


def _segments(turns: DataFrame, lengths: DataFrame, segment: int) -> DataFrame:
    """One row per conversation and segment: seg, head, depth (turns before the
    head), conv_id, ids, sizes, next (head of the following segment or null), w.
    Members of a following head are one row with their number w and smallest id."""
    n = lengths.select(F.col("conv_id").alias("c"), "n")
    t = turns.join(rekeyed(n, "c"), turns["conv_id"] == F.col("c"))
    one = F.struct("pos", "turn_id", "size")
    marks = n.select(F.col("c").alias("conv_id"), F.floor(F.col("n") / segment).cast("long").alias("seg"), "n",
                     F.lit(None).cast(t.select(one.alias("x")).schema["x"].dataType).alias("x"))
    t = t.select("conv_id", F.floor((F.col("pos") - 1) / segment).cast("long").alias("seg"), "n", one.alias("x"))
    g = t.unionByName(marks).groupBy("conv_id", "seg", "n").agg(F.array_sort(F.collect_list("x")).alias("x"))
    g = g.select("conv_id", "seg", "n", F.transform("x", lambda x: x["turn_id"]).alias("ids"),
                 F.transform("x", lambda x: x["size"]).alias("sizes"))
    g = stage(g, "trie-segments")
    short = g.filter(F.col("n") < segment).select("seg", F.lit("").alias("head"), "conv_id", "ids", "sizes",
                                                  F.lit(None).cast("string").alias("next"))
    # digests of what stands before a segment: two running xors over the segments' own digests
    own = F.array_join(F.transform("ids", F.hex), "")
    long_ones = g.filter(F.col("n") >= segment)
    part = long_ones.select("conv_id", "seg", *[F.xxhash64(F.lit(k), "seg", own).alias(f"x{k}") for k in (1, 2)])
    upto = "OVER (PARTITION BY conv_id ORDER BY seg ROWS UNBOUNDED PRECEDING)"
    heads = part.select("conv_id", "seg", F.concat(F.lit("s"), (F.col("seg") + 1).cast("string"), F.lit(":"), *[
        F.lpad(F.hex(F.expr(f"bit_xor(x{k}) {upto}")), 16, "0") for k in (1, 2)]).alias("after"))
    before = heads.select(F.col("conv_id").alias("c"), (F.col("seg") + 1).alias("s"), F.col("after").alias("before"))
    heads = heads.select(F.col("conv_id").alias("c2"), F.col("seg").alias("s2"), "after")
    long_ones = (long_ones.join(rekeyed(heads, "c2", "s2"), (F.col("conv_id") == F.col("c2")) & (F.col("seg") == F.col("s2")))
                 .join(rekeyed(before, "c", "s"), (F.col("conv_id") == F.col("c")) & (F.col("seg") == F.col("s")), "left"))
    long_ones = long_ones.select("seg", F.coalesce("before", F.lit("")).alias("head"), "conv_id", "ids", "sizes",
                                 F.when(F.size("ids") == segment, F.col("after")).alias("next"))
    follow = (long_ones.filter("next IS NOT NULL").groupBy("seg", "head", "next")
              .agg(F.min("conv_id").alias("conv_id"), F.first("ids").alias("ids"), F.first("sizes").alias("sizes"),
                   F.count(F.lit(1)).alias("w")))
    ended = short.unionByName(long_ones.filter("next IS NULL")).withColumn("w", F.lit(1).cast("long"))
    return ended.unionByName(follow).withColumn("depth", F.col("seg") * segment)


class _Level:
    """Containers of one round: the rows of those that are swept, and the parts
    of those that were burst."""

    def __init__(self, rows, over=None, tops=None, ended=None):
        self.rows, self.over, self.tops, self.ended = rows, over, tops, ended


def _burst(rows: DataFrame, container: int) -> tuple[_Level, DataFrame | None]:
    """One round: what is done at this level, and the rows under the new heads."""
    edge = F.struct("ids", "sizes")
    over = rows.groupBy("seg", "head", "depth").agg(
        F.sum(F.size("ids") + 1).alias("turns"), F.min(edge).alias("lo"), F.max("ids").alias("hi"),
        F.sum("w").alias("n"), F.min("conv_id").alias("low_conv"), F.max("next").alias("some_next"))
    over = over.filter(F.col("turns") > container)
    differ = F.array_position(F.zip_with("lo.ids", "hi", lambda a, b: a.eqNullSafe(b)), F.lit(False))
    shared = F.when(differ == 0, F.size("lo.ids")).otherwise(differ - 1).cast("int")
    # if all is shared and goes on in a next segment, the last turn is the one child
    shared = F.when((differ == 0) & F.col("some_next").isNotNull(), shared - 1).otherwise(shared)
    over = stage(over.select("seg", "head", "depth", shared.alias("shared"), "n", "low_conv",
                             F.slice("lo.sizes", F.lit(1), shared).alias("chain")), "trie-over")
    if over.isEmpty():
        return _Level(rows), None
    o = over.select(F.col("head").alias("o_head"), "shared", "low_conv")
    j = rows.join(rekeyed(o, "o_head"), F.col("head") == F.col("o_head"), "left")
    keep = j.filter("shared IS NULL").select(*rows.columns)
    j = j.filter("shared IS NOT NULL")
    ended = j.filter("next IS NULL AND size(ids) <= shared").select("seg", "head", "conv_id")
    cut = F.col("shared") + 1
    j = j.filter("NOT (next IS NULL AND size(ids) <= shared)")
    child = F.when(F.col("next").isNotNull() & (F.size("ids") == cut), F.col("next")) \
        .otherwise(F.concat(F.lit("b"), _head_digest(F.col("head"), F.slice("ids", F.lit(1), cut))))
    j = stage(j.select("*", child.alias("child")), "trie-cut")
    tops = (j.groupBy("seg", "head", "depth", "child", "shared", "low_conv")
            .agg(F.sum("w").alias("w"), F.min("conv_id").alias("conv_id"),
                 F.first(F.get("sizes", F.col("shared"))).alias("size")))
    rest = F.greatest(F.size("ids") - cut, F.lit(0))
    deeper = j.filter("next IS NULL OR child <> next").select(
        "seg", F.col("child").alias("head"), "conv_id", F.slice("ids", cut + 1, rest).alias("ids"),
        F.slice("sizes", cut + 1, rest).alias("sizes"), "next", "w", (F.col("depth") + cut).alias("depth"))
    return _Level(stage(keep, "trie-rows"), over, stage(tops, "trie-tops"), stage(ended, "trie-ended")), stage(deeper, "trie-deeper")


def _digests(ended: DataFrame) -> DataFrame:
    """head, ends: SHA-256 over the ascending ids of each head's members, streamed."""
    def run(batches):
        head, state, n = None, None, 0
        for b in batches:
            out = []
            for h, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if h != head:
                    if head is not None:
                        out.append((head, state.hexdigest()))
                    head, state, n = h, hashlib.sha256(), 0
                state.update(b"%d" % c if n == 0 else b",%d" % c)
                n += 1
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*out)], ["e_head", "ends"])
        if head is not None:
            yield pa.RecordBatch.from_arrays([pa.array([head]), pa.array([state.hexdigest()])], ["e_head", "ends"])
    rows = ended.select("head", "conv_id").repartition("head").sortWithinPartitions("head", "conv_id")
    return rows.transform(map_batches, run, "e_head string, ends string")


class _Container:
    """Nodes of the container being swept; node 0 is its head."""

    def __init__(self, head, depth):
        self.head, self.top, self.before, self.path = head, depth, [], [0]
        self.parent, self.depth, self.size = [None], [depth], [0]
        self.n, self.conv, self.ends = [0], [None], [None]
        self.children, self.leaves, self.saved, self.sha = [0], [0], [0], [None]

    def add(self, ids, sizes, conv, w, child):
        same = 0
        for a, b in zip(self.before, ids):
            if a != b:
                break
            same += 1
        del self.path[same + 1:]
        for k in range(same, len(ids)):
            for values, x in ((self.parent, self.path[-1]), (self.depth, self.top + k + 1), (self.size, sizes[k]), (self.n, 0),
                              (self.conv, None), (self.ends, None), (self.children, 0), (self.leaves, 0), (self.saved, 0),
                              (self.sha, None)):
                values.append(x)
            self.path.append(len(self.n) - 1)
        self.before, k = ids, self.path[-1]
        self.n[k] += w
        self.conv[k] = conv if self.conv[k] is None else min(self.conv[k], conv)
        if child is None:
            if self.ends[k] is None:
                self.ends[k] = hashlib.sha256(b"%d" % conv)
            else:
                self.ends[k].update(b",%d" % conv)
        else:
            self.children[k], self.leaves[k], self.saved[k], self.sha[k] = child

    def rows(self):
        for k in range(len(self.n) - 1, -1, -1):
            if not self.children[k]:
                self.leaves[k] = 1
            p = self.parent[k]
            if p is not None:
                self.saved[k] += (self.n[k] - 1) * self.size[k]
                self.n[p] += self.n[k]
                self.conv[p] = self.conv[k] if self.conv[p] is None else min(self.conv[p], self.conv[k])
                self.children[p] += 1
                self.leaves[p] += self.leaves[k]
                self.saved[p] += self.saved[k]
        for k in range(len(self.n)):
            p = self.parent[k]
            sha = self.sha[k] or (self.ends[k].hexdigest() if self.ends[k] else NOTHING)
            yield (self.head, k > 0, self.conv[k], self.depth[k], None if p is None else self.conv[p], self.n[k],
                   self.children[k], self.leaves[k], self.saved[k], sha)


_SWEPT = "head string, inner boolean, " + NODE
_SWEPT_NAMES = [x.split()[0] for x in _SWEPT.split(", ")]
_SWEPT_TYPES = [pa.string(), pa.bool_(), *[pa.int64()] * 7, pa.string()]
_CHILD = ("n_children", "n_leaves", "saved_tokens", "ends_sha256")


def _sweep(batches):
    now, out = None, []

    def batch():
        got = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _SWEPT_TYPES)], _SWEPT_NAMES)
        out.clear()
        return got
    for b in batches:
        for head, depth, ids, sizes, conv, w, follows, *child in zip(*[c.to_pylist() for c in b.columns]):
            if now is None or head != now.head:
                if now is not None:
                    out.extend(now.rows())
                    if len(out) >= 8192:
                        yield batch()
                now = _Container(head, depth)
            now.add(ids, sizes, conv, w, child if follows else None)
    if now is not None:
        out.extend(now.rows())
    if out:
        yield batch()


def _with_child(rows: DataFrame, key: str, totals: DataFrame | None) -> DataFrame:
    """Adds the totals of the head that ``key`` names."""
    if totals is None:
        return rows.select("*", *[F.lit(None).cast("long").alias(f"c_{c}") for c in _CHILD[:3]],
                           F.lit(None).cast("string").alias("c_ends_sha256"))
    t = totals.select(F.col("head").alias("c_head"), *[F.col(c).alias(f"c_{c}") for c in _CHILD])
    return rows.join(rekeyed(t, "c_head"), F.col(key) == F.col("c_head"), "left").drop("c_head")


def _swept(rows: DataFrame, totals: DataFrame | None) -> DataFrame:
    plain = _with_child(rows.filter("next IS NULL"), "next", None)
    follow = _with_child(rows.filter("next IS NOT NULL"), "next", totals)
    r = plain.unionByName(follow).select("head", "depth", "ids", "sizes", "conv_id", "w",
                                         F.col("next").isNotNull().alias("follows"), *[f"c_{c}" for c in _CHILD])
    return r.repartition("head").sortWithinPartitions("head", "ids", "conv_id").transform(map_batches, _sweep, _SWEPT)


def _burst_nodes(level: _Level, seg: int, totals: DataFrame | None) -> DataFrame:
    """Nodes and totals of the heads that were burst, in the form of a sweep."""
    here = F.col("seg") == seg
    tops = _with_child(level.tops.filter(here), "child", totals)
    tops = tops.withColumn("c_saved_tokens", F.col("c_saved_tokens") + (F.col("w") - 1) * F.col("size"))
    children = tops.select("head", F.lit(True).alias("inner"), "conv_id", (F.col("depth") + F.col("shared") + 1).alias("depth"),
                           F.col("low_conv").alias("parent_conv_id"), F.col("w").alias("n_convs"),
                           *[F.col(f"c_{c}").alias(c) for c in _CHILD])
    per = tops.groupBy(F.col("head").alias("t_head")).agg(
        F.count(F.lit(1)).alias("k"), F.sum("c_n_leaves").alias("leaves"), F.sum("c_saved_tokens").alias("below"))
    o = (level.over.filter(here).join(per, F.col("head") == F.col("t_head"), "left")
         .join(_digests(level.ended.filter(here)), F.col("head") == F.col("e_head"), "left"))
    at = F.col("at")
    o = o.withColumn("at", F.explode(F.sequence(F.lit(0), F.col("shared"))))  # 0: the head itself
    last = at == F.col("shared")
    rest = F.slice("chain", F.greatest(at, F.lit(1)), F.col("shared") - F.greatest(at, F.lit(1)) + 1)
    saved = F.aggregate(rest, F.lit(0).cast("long"), lambda s, x: s + x) * (F.col("n") - 1)
    chain = o.select("head", (at > 0).alias("inner"), F.col("low_conv").alias("conv_id"), (F.col("depth") + at).alias("depth"),
                     F.when(at > 0, F.col("low_conv")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
                     F.when(last, F.coalesce("k", F.lit(0))).otherwise(1).cast("long").alias("n_children"),
                     F.coalesce("leaves", F.lit(1)).cast("long").alias("n_leaves"),
                     (saved + F.coalesce("below", F.lit(0))).cast("long").alias("saved_tokens"),
                     F.when(last, F.coalesce("ends", F.lit(NOTHING))).otherwise(NOTHING).alias("ends_sha256"))
    return children.unionByName(chain)


def build_trie(turns: DataFrame, lengths: DataFrame, segment: int = SEGMENT, container: int = CONTAINER) -> DataFrame:
    """Nodes of the trie over the sequences. ``turns``: conv_id, pos (1 to the
    sequence's length), turn_id binary, size; ``lengths``: conv_id, n, one row
    per sequence, 0 included. Columns as in ``NODE``: a node is named by its
    smallest member and its depth; n_leaves and saved_tokens are sums over the
    node's subtree, saved_tokens of (n_convs - 1) times the last turn's size."""
    rows = stage(_segments(turns, lengths, segment), "trie-rows")
    last_seg = rows.agg(F.max("seg")).first()[0]  # one number
    if last_seg is None:
        return turns.sparkSession.createDataFrame([], NODE)
    levels = []
    while rows is not None:
        level, rows = _burst(rows, container)
        levels.append(level)
    done, totals = [], {}
    for seg in range(last_seg, -1, -1):
        for b in range(len(levels) - 1, -1, -1):
            level = levels[b]
            below = [t for t in (totals.get((seg, b + 1)), totals.get((seg + 1, 0))) if t is not None]
            below = below[0].unionByName(below[1]) if len(below) == 2 else below[0] if below else None
            out = _swept(level.rows.filter(F.col("seg") == seg), below)
            if level.over is not None:
                out = out.unionByName(_burst_nodes(level, seg, below))
            out = stage(out, "trie-nodes")
            totals[seg, b] = out.filter(~F.col("inner"))
            done.append(out.filter("inner" if (seg, b) != (0, 0) else "inner OR head = ''"))
    names = [x.split()[0] for x in NODE.split(", ")]
    return _union(done).select(*names)


def _union(frames: list[DataFrame]) -> DataFrame:
    while len(frames) > 1:
        frames = [a.unionByName(b) if b is not None else a for a, b in zip(frames[::2], [*frames[1::2], None])]
    return frames[0]


def conversation_trie(conversations: DataFrame, segment: int = SEGMENT, container: int = CONTAINER) -> DataFrame:
    """``build_trie`` over the conversations as they are."""
    turns = stage(turn_rows(conversations), "trie-positions")
    return build_trie(turns, turns.groupBy("conv_id").agg(F.max("pos").alias("n")), segment, container)
