"""K-d tree sharding: split at weighted medians along the widest metadata dimension.

A node that stands for k shards is cut into floor(k/2) and ceil(k/2) of them, at the value below which
that share of its bytes lies, along the dimension in which its rows are spread widest (relative to the
spread of the whole table). Cuts are found by histograms: each pass sums the bytes of at most
``BINS`` bins per open node, in tasks first, and narrows the interval that holds the cut. Where one value
holds more than the cut can spare, such as a source with a third of all rows, the cut goes on within that
value along a hash of the row's number. The driver sees nothing but nodes and bins; no rows are moved.

Defined cases: a null text has no bytes; null dimensions sort below all values; repeated rows are told
apart by the number they get when the table is staged, which also orders rows that tie in a dimension; very long
texts count with their whole size, and shards are as equal as whole documents allow; an empty table has no rows in any shard. Other
columns pass through ``shard_documents`` unchanged, whatever their names (a column ``shard`` is replaced).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import col, fresh
from tallyloom.sources.staging import stage

BINS = 4096
#: Range of the hash that orders rows of one value.
TIES = 1 << 40


@dataclass
class Node:
    """Shards ``first`` to ``first + shards - 1``; inner nodes have a cut and two children."""

    first: int
    shards: int
    dim: str = ""
    value: int = 0
    tie: int = 0
    children: list[Node] = field(default_factory=list)

    def place(self, leaf, prefix: str = "") -> Column:
        """Expression for what ``leaf`` gives for the leaf that a row falls into."""
        if not self.children:
            return F.lit(leaf(self))
        left, right = self.children
        on, tie = F.col(prefix + self.dim), F.col(prefix + "tie")
        below = (on < self.value) | ((on == self.value) & (tie < self.tie))
        return F.when(below, left.place(leaf, prefix)).otherwise(right.place(leaf, prefix))

    def leaves(self) -> list[Node]:
        return [self] if not self.children else [x for c in self.children for x in c.leaves()]


def document_bytes(text: str) -> Column:
    """UTF-8 bytes of the text, and 8 for its length."""
    return F.coalesce(F.octet_length(col(text)), F.lit(0)).cast("long") + 8


def _code(df: DataFrame, name: str) -> Column:
    """A dimension as a whole number in the order of its values: strings by their first seven bytes."""
    if isinstance(df.schema[name].dataType, T.IntegralType):
        return F.shiftright(col(name).cast("long"), 1)
    head = F.rpad(F.hex(F.substring(col(name).cast("string").cast("binary"), 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("long")


def _cuts(rows: DataFrame, nodes: dict[int, Node], ranges: dict[int, tuple[int, int]], totals: dict[int, int], spare: float):
    """Set value and tie of every node in ``nodes``; ``ranges`` are those of their dimensions."""
    at = {k: {"lo": lo, "hi": hi, "left": 0, "want": totals[k] * (n.shards // 2) / n.shards, "tied": None} for k, n in nodes.items() for lo, hi in [ranges[k]]}

    def settle(k: int, coordinate: int) -> None:
        s, n = at.pop(k), nodes[k]
        n.value, n.tie = (s["tied"], coordinate) if s["tied"] is not None else (coordinate, 0)

    for k in list(at):
        if at[k]["lo"] == at[k]["hi"]:
            at[k] |= {"tied": at[k]["lo"], "lo": 0, "hi": TIES - 1}
    while at:
        chosen, bins, at_value = F.lit(None).cast("int"), F.lit(None).cast("long"), F.lit(None).cast("long")
        for k, s in at.items():
            s["step"] = -(-(s["hi"] - s["lo"] + 1) // BINS)
            on = F.col("tie") if s["tied"] is not None else F.col(nodes[k].dim)
            inside = (F.col("node") == k) & on.between(s["lo"], s["hi"])
            if s["tied"] is not None:
                inside &= F.col(nodes[k].dim) == s["tied"]
            chosen = F.when(inside, F.lit(k)).otherwise(chosen)
            bins = F.when(inside, F.call_function("div", on - s["lo"], F.lit(s["step"]).cast("long"))).otherwise(bins)
            at_value = F.when(inside, on).otherwise(at_value)
        counted = (
            rows.select(chosen.alias("k"), bins.alias("bin"), at_value.alias("at"), "size")
            .filter("k IS NOT NULL")
            .groupBy("k", "bin")
            .agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"), F.min("at").alias("lo"), F.max("at").alias("hi"))
        )
        found: dict[int, list[tuple]] = {k: [] for k in at}
        for r in counted.collect():  # at most BINS rows per open node
            found[r.k].append((r.bin, r.bytes, r.n, r.lo, r.hi))
        for k, got in found.items():
            s = at[k]
            for _, weight, n, lo, hi in sorted(got):
                if s["left"] + weight >= s["want"]:
                    break
                s["left"] += weight
            nearer_end = s["left"] + weight - s["want"] < s["want"] - s["left"]
            if weight <= spare or n == 1 or (s["tied"] is not None and lo == hi):
                settle(k, hi + 1 if nearer_end else lo)
            elif lo == hi:
                s |= {"tied": lo, "lo": 0, "hi": TIES - 1}
            else:
                s |= {"lo": lo, "hi": hi}


def _place(raw: Sequence[str], lowest: dict[str, int | None], number: str) -> list[Column]:
    """The coordinates of a row: its dimensions, nulls below all values, and the hash that orders ties."""
    coded = [F.coalesce(F.col(c), F.lit(0 if lowest[c] is None else lowest[c] - 1).cast("long")) for c in raw]
    return [x.alias(c) for x, c in zip(coded, raw, strict=True)] + [F.pmod(F.xxhash64(number), F.lit(TIES)).alias("tie")]


def _tree(staged: DataFrame, names: Sequence[str], shards: int, tolerance: float) -> tuple[Node, dict[str, int | None]]:
    """The tree over staged rows (``number``, ``size`` and dimensions), and the least value of each dimension."""
    root = Node(0, shards)
    lowest = staged.agg(*[F.min(c).alias(c) for c in names], F.max("number").alias("last")).first().asDict()
    rows = staged.select("size", *_place(names, lowest, "number"))
    if lowest["last"] is None:
        return root, lowest
    spread: dict[str, int] = {}
    while wide := {i: n for i, n in enumerate(root.leaves()) if n.shards > 1}:
        index = {id(n): i for i, n in enumerate(root.leaves())}
        placed = rows.withColumn("node", root.place(lambda n: index[id(n)]))
        extent = placed.groupBy("node").agg(
            F.sum("size").alias("bytes"), *[F.min(c).alias(f"{c}_lo") for c in names], *[F.max(c).alias(f"{c}_hi") for c in names]
        )
        known = {r.node: r for r in extent.collect()}  # one row per node
        spread = spread or {c: max(1, known[0][f"{c}_hi"] - known[0][f"{c}_lo"]) for c in names}
        open_nodes, ranges, totals = {}, {}, {}
        for i, n in wide.items():
            if r := known.get(i):
                n.dim = max(names, key=lambda c: (r[f"{c}_hi"] - r[f"{c}_lo"]) / spread[c])
                open_nodes[i], ranges[i], totals[i] = n, (r[f"{n.dim}_lo"], r[f"{n.dim}_hi"]), r.bytes
                leaf_bytes = r.bytes / n.shards
            else:  # no rows: any cut will do
                n.dim = names[0]
        if open_nodes:
            _cuts(placed, open_nodes, ranges, totals, tolerance * leaf_bytes)
        for n in wide.values():
            half = n.shards // 2
            n.children = [Node(n.first, half), Node(n.first + half, n.shards - half)]
    return root, lowest


def shard_count(df: DataFrame, text: str, target_bytes: int) -> int:
    """Leaves needed for a target size."""
    total = df.agg(F.sum(document_bytes(text))).first()[0] or 0
    return max(1, -(-total // target_bytes))


def shard_documents(
    df: DataFrame,
    shards: int,
    text: str = "text",
    dims: Sequence[str] = ("lang", "source", "n_chars", "doc_id"),
    tolerance: float = 0.0005,
) -> DataFrame:
    """``df`` with a column ``shard``, ready to be written ``partitionBy("shard")``."""
    number, at = fresh(df, "number"), fresh(df, "at")
    names = [f"d{i}" for i in range(len(dims))]
    numbered = stage(df.withColumn(number, F.monotonically_increasing_id()))
    codes = [_code(numbered, d).alias(c) for d, c in zip(dims, names, strict=True)]
    staged = stage(numbered.select(col(number).alias("number"), document_bytes(text).alias("size"), *codes))
    root, lowest = _tree(staged, names, shards, tolerance)
    # The tree is an expression over the row itself, so texts need no join to their shards.
    raw = numbered.withColumn(at, F.struct(*codes, col(number).alias("number")))
    coordinates = F.struct(*_placed_in(at, names, lowest))
    kept = [col(c) for c in df.columns if c.lower() != "shard"]
    return raw.withColumn(at, coordinates).select(*kept, root.place(lambda n: n.first, f"{at}.").cast("int").alias("shard"))


def _placed_in(struct: str, names: Sequence[str], lowest: dict[str, int | None]) -> list[Column]:
    raw = _place([f"{struct}.{c}" for c in names], {f"{struct}.{c}": lowest[c] for c in names}, f"{struct}.number")
    return [x.alias(c) for x, c in zip(raw, [*names, "tie"], strict=True)]


def shard_report(
    df: DataFrame,
    shards: int = 24,
    doc_id: str = "doc_id",
    text: str = "text",
    dims: Sequence[str] = ("lang", "source", "n_chars", "doc_id"),
    tolerance: float = 0.0005,
    slots_at_once: int = 50_000,
) -> DataFrame:
    """Per document: size, checksum of its text, shard, and a slot that counts from 0 within the shard.

    Slots are dealt in pieces of a shard, each of about ``slots_at_once`` rows, so that no task numbers a whole shard.
    """
    names = [f"d{i}" for i in range(len(dims))]
    staged = stage(
        df.select(
            F.monotonically_increasing_id().alias("number"),
            document_bytes(text).alias("size"),
            *[_code(df, d).alias(c) for d, c in zip(dims, names, strict=True)],
            col(doc_id).alias("doc_id"),
            F.coalesce(F.crc32(col(text).cast("binary")), F.lit(0)).cast("long").alias("text_crc32"),
        )
    )
    root, lowest = _tree(staged, names, shards, tolerance)
    pieces = max(64, -(-staged.count() // (shards * slots_at_once)))
    placed = staged.select("number", "doc_id", "size", "text_crc32", *_place(names, lowest, "number")).select(
        "number",
        "doc_id",
        "size",
        "text_crc32",
        root.place(lambda n: n.first).cast("int").alias("shard"),
        F.pmod(F.col("tie"), F.lit(pieces)).alias("piece"),
    )
    before = Window.partitionBy("shard").orderBy("piece").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "piece").agg(F.count(F.lit(1)).alias("n"))
    starts = starts.select("shard", "piece", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "piece").orderBy("number")
    return (
        placed.withColumn("i", F.row_number().over(within) - 1)
        .join(stage(starts), ["shard", "piece"])
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("start") + F.col("i")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )
