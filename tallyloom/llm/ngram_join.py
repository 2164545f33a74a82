"""Similarity join of documents on word shingles, by T-occurrence search over divided inverted lists.

Two documents of sizes a and b are similar at ``percent`` p if they share at least T = p / (100 + p) * (a + b)
shingles. Each document's shingles are put in one order, rare ones first, and it is listed under its first
n - ceil(p * n / 100) + 1 only, of which every similar pair has one in common. Which shingles are frequent is told
by a filter of fixed size; it decides the order only, and any order is exact.

Documents that meet in short lists are counted pair by pair; pairs that cannot reach T with all that is left are
dropped, and the others probed by binary search. Long lists are searched in groups, by DivideSkip: for each
document, its longest lists are set aside and the others merged; documents that occur often enough are probed in
the long lists, until they reach T or cannot any more. A group holds the lists with one head, so a family of
copies is searched once, and not once per list; groups beyond ``block`` shingles are cut into blocks.

Documents with equal sets are one class. Links between documents that other links connect are not all listed,
but no two documents that links connect fall apart: the components are those of all links.

Defined cases: null and empty texts have no shingles and are linked with nothing; with fewer words than a
shingle the whole text is one; a null id counts as larger than all others; repeated rows are linked with each
other; very long texts are read whole, and their sets are cut into blocks; no order is asked for, so that nothing
can tie but ids, and ``keep_one`` keeps one row of those; an empty table gives an empty result. Other columns pass
through ``keep_one`` unchanged, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col, fresh
from tallyloom.llm.components import components
from tallyloom.llm.hashing import Filter, WordHashes, signed, windows
from tallyloom.sources.staging import stage

LAST = (1 << 63) - 1


def shingles(text: str | None, known: WordHashes, width: int) -> np.ndarray:
    """The sorted set of a text's shingles, words in lower-case ASCII."""
    tokens = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not tokens:
        return np.zeros(0, np.uint64)
    k = min(width, len(tokens))
    return np.unique(windows(known.of(tokens), k) + np.uint64(width - k))


def fingerprint(s: np.ndarray) -> tuple[int, int]:
    return tuple(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), np.int64).tolist())


def prefix_length(n, percent: int):
    return n - (n * percent + 99) // 100 + 1


class Join:
    """One join; the texts are read once per step, and only narrow rows are shuffled."""

    def __init__(self, docs: DataFrame, percent: int, width: int, list_length: int, filter_bits: int, block: int):
        """``docs``: ``id`` (long, not null) and ``text`` (not null); ``block``: shingles of a block."""
        self.docs, self.percent, self.width, self.block = docs, percent, width, block
        self.list_length, self.filter_bits = list_length, filter_bits

    def each_text(self, give, schema: str) -> DataFrame:
        """Rows that ``give(fingerprint, sorted set)`` returns as columns, once per distinct set in a task."""
        width, names = self.width, [x.split()[0] for x in schema.split(", ")]

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known, seen = WordHashes(), set()
            for b in batches:
                parts = []
                for t in b["text"]:
                    s = shingles(t, known, width)
                    f = fingerprint(s)[0]
                    if len(s) and f not in seen:
                        seen.add(f)
                        if (part := give(f, s)) is not None:
                            parts.append(part)
                yield pd.DataFrame({n: np.concatenate(x) if not isinstance(x[0], list) else sum(x, []) for n, x in zip(names, zip(*parts, strict=True), strict=True)} if parts else {n: [] for n in names})

        return self.docs.select("text").mapInPandas(run, schema)

    def classes(self) -> DataFrame:
        """Per document: ``id, n, f, f2``, and once per distinct set in a task ``least``, its least shingles."""
        width, percent = self.width, self.percent

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            known, seen = WordHashes(), set()
            for b in batches:
                sets = [shingles(t, known, width) for t in b["text"]]
                prints = [fingerprint(s) for s in sets]
                least = []
                for s, (f, _) in zip(sets, prints, strict=True):
                    least.append([] if f in seen or not len(s) else signed(s[: prefix_length(len(s), percent)]))
                    seen.add(f)
                yield b.drop(columns="text").assign(
                    n=[len(s) for s in sets], f=[p[0] for p in prints], f2=[p[1] for p in prints], least=least
                )

        kept = [f for f in self.docs.schema.fields if f.name != "text"]
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept) + ", n long, f long, f2 long, least array<long>"
        return stage(self.docs.mapInPandas(run, schema))

    def lists(self, classes: DataFrame) -> DataFrame:
        """The inverted lists that hold at least two sets: ``token, f, n, w``.

        ``w`` is the order of the last shingle that a set is listed under.
        """
        percent = self.percent

        counts = classes.select(F.explode("least").alias("token")).groupBy("token").count().filter(F.col("count") > self.list_length)
        listed = self.docs.sparkSession.sparkContext.broadcast(Filter.build(counts, "token", self.filter_bits).words)

        def listing(f: int, s: np.ndarray):
            often = Filter(listed.value).has(s)
            p = prefix_length(len(s), percent)
            ordered = np.concatenate([s[~often], s[often]])[:p]
            w = int(ordered[-1] >> np.uint64(34)) | (int((~often).sum()) < p) << 30
            return signed(ordered), np.full(p, f, np.int64), np.full(p, len(s), np.int32), np.full(p, w, np.int32)

        rows = self.each_text(listing, "token long, f long, n int, w int").repartition(F.col("token")).sortWithinPartitions("token", "f")

        def shared(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            left = None
            for b in batches:
                b = b if left is None else pd.concat([left, b], ignore_index=True)
                b = b[~((b["token"] == b["token"].shift()) & (b["f"] == b["f"].shift()))]
                # The last row waits for its successor; what stands before it is told by `met`.
                met = (b["token"] == b["token"].shift()) | (b["token"] == b["token"].shift(-1))
                if left is not None and self_met and len(b):
                    met.iloc[0] = True
                self_met = bool(len(b) > 1 and b["token"].iloc[-1] == b["token"].iloc[-2]) or (len(b) == 1 and left is not None and self_met)
                left = b.iloc[-1:]
                yield b.iloc[:-1][met.iloc[:-1]]
            if left is not None and len(left) and self_met:
                yield left

        return stage(rows.mapInPandas(shared, "token long, f long, n int, w int"))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """``f, s`` of the sets that ``wanted`` (``f``) asks for, and of few others; staged."""
        asked = self.docs.sparkSession.sparkContext.broadcast(Filter.build(wanted, "f", self.filter_bits).words)

        def give(f: int, s: np.ndarray):
            return ([f], [s.tobytes()]) if Filter(asked.value).has(np.array([f]))[0] else None

        # A set that several tasks have met is taken once.
        return stage(self.each_text(give, "f long, s binary").groupBy("f").agg(F.first("s").alias("s")))

    def _sizes_allow(self, a: str, b: str):
        return (F.col(a) * 100 >= F.col(b) * self.percent) & (F.col(b) * 100 >= F.col(a) * self.percent)

    def short_pairs(self, lists: DataFrame) -> DataFrame:
        """Pairs (``a, b``) that meet in short lists and can still reach the overlap; staged.

        A pair that meets in a long list as well is found there, whatever is counted here.
        """
        a, b = (lists.select("token", *[F.col(c).alias(f"{c}{x}") for c in ("f", "n", "w")]) for x in ("a", "b"))
        met = a.join(b, "token").filter((F.col("fa") < F.col("fb")) & self._sizes_allow("na", "nb"))
        counted = met.groupBy("fa", "fb", "na", "nb", "wa", "wb").agg(F.count(F.lit(1)).alias("c"))
        p = self.percent
        # Shingles not counted come after the last one listed, of the set whose list ends first.
        left = {x: F.floor((F.col(f"n{x}") * p + 99) / 100) - 1 for x in ("a", "b")}
        rest = F.when(F.col("wa") < F.col("wb"), left["a"]).when(F.col("wa") > F.col("wb"), left["b"]).otherwise(F.greatest(left["a"], left["b"]))
        enough = (F.col("c") + rest) * (100 + p) >= (F.col("na") + F.col("nb")) * p
        return stage(counted.filter(enough).select(F.col("fa").alias("a"), F.col("fb").alias("b")))

    def groups(self, lists: DataFrame) -> DataFrame:
        """Members (``h, i, j, f``) of the groups in which long lists are searched; staged.

        Lists with the same head make one group, so that sets which share many lists are compared once. The head is
        the least member by a hash, mostly the same in all lists of a family. Groups of many shingles are cut into
        blocks; block ``i`` is searched against block ``j``.
        """
        head = lists.groupBy("token").agg(F.min(F.struct(F.xxhash64("f"), "f")).alias("h")).select("token", F.col("h.f").alias("h"))
        members = lists.join(head, "token").groupBy("h", "f").agg(F.any_value("n").alias("n"))
        members = stage(members)
        sizes = members.groupBy("h").agg(F.ceil(F.sum("n") / self.block).cast("int").alias("blocks"))
        own = F.pmod(F.xxhash64("f", F.lit(1)), F.col("blocks")).cast("int")
        dealt = members.join(sizes, "h").withColumn("own", own).select("h", "f", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        return stage(dealt.select("h", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "f"))

    def links(self, lists: DataFrame) -> DataFrame:
        """All pairs (``a, b``) of similar sets, but for pairs that other links connect."""
        lengths = lists.groupBy("token").agg(F.count(F.lit(1)).alias("m"))
        sized = stage(lists.join(lengths, "token"))
        pairs = self.short_pairs(sized.filter(F.col("m") <= self.list_length).drop("m"))
        groups = self.groups(sized.filter(F.col("m") > self.list_length).drop("m"))
        sets = self.sets(pairs.select(F.explode(F.array("a", "b")).alias("f")).unionByName(groups.select("f")).distinct())
        percent = self.percent

        def probe(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for b in batches:
                good = []
                for x, y in zip(b["sa"], b["sb"], strict=True):
                    x, y = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
                    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
                    both = int((y[at] == x).sum())
                    good.append(100 * both >= percent * (len(x) + len(y) - both))
                yield b.loc[good, ["a", "b"]]

        def search(group: pd.DataFrame) -> pd.DataFrame:
            found = divide_skip([np.frombuffer(x, np.uint64) for x in group["s"]], group["own"].to_numpy(), percent)
            f = group["f"].to_numpy()
            return pd.DataFrame({"a": f[found[:, 0]], "b": f[found[:, 1]]})

        joined = pairs.join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b").select("a", "b", "sa", "sb")
        searched = groups.join(sets, "f").groupBy("h", "i", "j").applyInPandas(search, "a long, b long")
        return stage(joined.mapInPandas(probe, "a long, b long").unionByName(searched))

    def roots(self, classes: DataFrame) -> DataFrame:
        """``f, root`` of the sets that are linked with a set that has a smaller fingerprint."""
        return components(self.links(self.lists(classes)), "a", "b").toDF("f", "root")


def divide_skip(sets: list[np.ndarray], blocks: np.ndarray, percent: int) -> np.ndarray:
    """Index pairs of similar sets; of two blocks, only pairs across them.

    For each set the longest lists are set aside, fewer than the overlap it needs. The others are merged, and what
    occurs in enough of them is probed in the long ones by binary search. Sets already connected are left out, so
    the pairs connect what all links connect.
    """
    n = np.array([len(s) for s in sets])
    order = np.argsort(n, kind="stable")
    n, across = n[order], len(np.unique(blocks)) > 1
    blocks = blocks[order]
    tokens, members = np.concatenate([sets[k] for k in order]), np.repeat(np.arange(len(order)), n)
    by_token = np.argsort(tokens, kind="stable")
    tokens, members = tokens[by_token], members[by_token]
    starts = np.flatnonzero(np.r_[True, tokens[1:] != tokens[:-1]])
    ends, heads = np.r_[starts[1:], len(tokens)], tokens[starts]
    root, out = np.arange(len(order)), []
    for q in range(len(order)):
        # Partners of at least its size come later in the order.
        last = int(np.searchsorted(n, n[q] * 100 // percent, side="right"))
        if last <= q + 1:
            continue
        at = np.searchsorted(heads, sets[order[q]])
        lengths = ends[at] - starts[at]
        at = at[np.argsort(lengths)]
        need = -(-percent * (n[q] + n[q]) // (100 + percent))
        aside = min(int((lengths > 8).sum()), max(0, (need - 1) // 2))
        short, long = at[: len(at) - aside], at[len(at) - aside :]
        merged = np.concatenate([members[starts[t] : ends[t]] for t in short]) if len(short) else members[:0]
        counts = np.bincount(merged[(merged > q) & (merged < last)] - q - 1, minlength=last - q - 1)
        wanted = -(-percent * (n[q] + n[q + 1 : last]) // (100 + percent))
        open_ = (counts + aside >= wanted) & (root[q + 1 : last] != root[q])
        if across:
            open_ &= blocks[q + 1 : last] != blocks[q]
        c = np.flatnonzero(open_)
        total = counts[c]
        for k, t in enumerate(long):
            if not len(c):
                break
            listed = members[starts[t] : ends[t]]
            place = np.minimum(np.searchsorted(listed, c + q + 1), len(listed) - 1)
            total = total + (listed[place] == c + q + 1)
            possible = total + (aside - 1 - k) >= wanted[c]
            c, total = c[possible], total[possible]
        for d in c[total >= wanted[c]] + q + 1:
            if root[d] != root[q]:
                out.append((order[q], order[d]))
                root[root == root[d]] = root[q]
    return np.array(out, np.int64).reshape(-1, 2)


def linked(docs: DataFrame, percent: int = 75, width: int = 5, list_length: int = 4, filter_bits: int = 1 << 26, block: int = 1 << 20) -> DataFrame:
    """Rows of ``docs`` (``id`` and ``text``, neither null, and others) with ``n`` and ``root`` in place of the text.

    Rows of one root are connected by links; rows without shingles have a null root.
    """
    join = Join(docs, percent, width, list_length, filter_bits, block)
    rows = join.classes()
    out = rows.drop("least").join(join.roots(rows), "f", "left")
    return stage(out.withColumn("root", F.when(F.col("n") > 0, F.coalesce("root", "f"))).drop("f", "f2"))


def similarity_report(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """Per document: ``doc_id, n_shingles, component_id``, the least id that links lead to."""
    docs = df.select(F.coalesce(col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"))
    rows = linked(docs, **how)
    least = rows.filter("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("least"))
    out = rows.join(least, "root", "left")
    return out.select(
        F.nullif("id", F.lit(LAST)).alias("doc_id"),
        F.col("n").alias("n_shingles"),
        F.nullif(F.coalesce("least", "id"), F.lit(LAST)).alias("component_id"),
    )


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """One row of each group of linked documents, the one with the least id; rows without words all stay."""
    number = fresh(df, "number")
    numbered = stage(df.withColumn(number, F.monotonically_increasing_id()))
    docs = numbered.select(
        F.coalesce(col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"), F.col(number).alias("number")
    )
    rows = linked(docs, **how).filter("root IS NOT NULL")
    stays = rows.groupBy("root").agg(F.min(F.struct("id", "number")).alias("one"))
    gone = stage(rows.join(stays, "root").filter("number != one.number").select(F.col("number").alias(number)))
    return numbered.join(gone, number, "left_anti").select(*[col(c) for c in df.columns])
