"""Ranked lexical search over bit-sliced Bloom signatures.

Every document has a signature: a Bloom filter of its terms and, for terms that occur several times, of the levels
of ``LEVELS`` that their counts reach. Documents of like size lie in one block, whose signatures are kept by slice:
row r of a block holds bit r of all its documents, so that a term is looked up in all of them by joining a few rows.

1. ``index``: one pass over the texts gives the blocks (ids, lengths, slices) and each block's terms with the number
   of its documents that hold them.
2. ``search``, for a block of queries at a time: the weights come from the terms' counts over all blocks. In each block
   the slices tell how often a document may hold a term, never less often than it does; the weighted sum over the
   slices bounds the document's score from above. The ``top`` documents with the highest bounds are scored by their
   texts; the least of these scores is a floor under the last place.
3. Every document whose bound is not below the floor is scored by its text, and the best are ranked. What is left out
   is proven to rank lower; Bloom filters that err only add documents to be scored.

Terms are maximal runs of letters, digits and characters beyond ASCII, A-Z lower-cased. Weights and scores are integers
(``weight``, ``impact``). Memory: a task holds the open blocks of one signature size each and one block of queries;
the driver holds the terms of one block of queries.

Defined cases: null and empty texts have no terms, are not counted and not found; very long texts are read whole, and
one that alone passes ``block_terms`` is a block of its own; equal scores rank by ascending id, null ids last; repeated
rows are documents of their own; queries equal in id and text are one query, and two texts with one id are ranked
apart; queries without terms and empty tables give no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.common import col
from tallyloom.llm.hashing import mixed
from tallyloom.sources.staging import stage

LAST = (1 << 63) - 1
#: Counts at which a term enters the signature once more. A count below the first level it misses is bounded by it.
LEVELS = [1, 2, 3, 4, 6, 8, 12, 16, 24, 32, 48, 64, 96, *(1 << k for k in range(7, 32))]
#: Bits set for a term; its rows are spread by two hashes.
HASHES = 6
#: Documents of a block at most.
BLOCK_DOCS = 2048
#: Terms whose hashes a task remembers.
KNOWN = 100_000

_TERMS = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c > 127 else 32 for c in range(256))


def terms(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TERMS).split() if text else []


def weight(documents: int, holding: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * holding + 1)))


def length_share(n, documents: int, length: int):
    """100 - 75 + 75 * n / (average length); Python integers, or numpy objects where a product might not fit."""
    return 25 + (75 * n * documents) // length


def impact(tf, m):
    """1000 times the saturated count; rises with ``tf``."""
    return (1_000_000_000 * tf) // (1000 * tf + 8 * m)


def _hashes(found: list[bytes], seen: dict[bytes, int]) -> np.ndarray:
    if len(seen) > KNOWN:
        seen.clear()
    return np.fromiter((seen.get(t) or seen.setdefault(t, xxhash.xxh3_64_intdigest(t) | 1) for t in found), np.uint64, len(found))


def _level(h: np.ndarray, level: int) -> np.ndarray:
    """The key under which a term's hash enters the signature for a level."""
    return mixed(h + np.uint64((level * 0x9E3779B97F4A7C15) % (1 << 64)))


def _rows(keys: np.ndarray, bits: int) -> np.ndarray:
    """The slices of each key, ``HASHES`` columns."""
    step = (keys >> np.uint64(32)) | np.uint64(1)
    return ((keys[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) % np.uint64(bits)).astype(np.int64)


class _Block:
    """Documents whose signatures have one size."""

    def __init__(self, size: int):
        self.bits = math.ceil((1 << size) * HASHES / math.log(2))
        self.ids, self.lengths, self.keys, self.holding = [], [], [], Counter()

    def add(self, doc_id: int, counts: Counter, keys: np.ndarray) -> None:
        self.ids.append(doc_id)
        self.lengths.append(sum(counts.values()))
        self.keys.append(keys)
        self.holding.update(counts.keys())

    def frame(self) -> pd.DataFrame:
        set_bits = np.zeros((self.bits, len(self.ids)), bool)
        for d, keys in enumerate(self.keys):
            set_bits[_rows(keys, self.bits).ravel(), d] = True
        held = list(self.holding)
        return pd.DataFrame({
            "ids": [np.array(self.ids, np.int64).tobytes()], "lengths": [np.array(self.lengths, np.int64).tobytes()], "bits": [self.bits],
            "slices": [np.packbits(set_bits, axis=1).tobytes()],
            "terms": [[t.decode("utf-8", "surrogatepass") for t in held]], "holding": [[self.holding[t] for t in held]],
        })


BLOCKS = "ids binary, lengths binary, bits int, slices binary, terms array<string>, holding array<int>"


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_terms: int = 1 << 17) -> DataFrame:
    """Signature blocks of all documents with a term. ``block_terms`` bounds the keys of a block, and so a task's memory."""

    def sign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        blocks, filled, seen = {}, Counter(), {}
        for b in batches:
            for i, t in zip(b["id"], b["text"], strict=True):
                counts = Counter(terms(t))
                if not counts:
                    continue
                h, tf = _hashes(list(counts), seen), np.fromiter(counts.values(), np.int64, len(counts))
                keys, level = [], 0
                while len(h):
                    keys.append(_level(h, level))
                    level += 1
                    more = tf >= LEVELS[level]
                    h, tf = h[more], tf[more]
                keys = np.concatenate(keys)
                size = max(2, math.ceil(math.log2(len(keys))))
                blocks.setdefault(size, _Block(size)).add(i, counts, keys)
                filled[size] += len(keys)
                if filled[size] >= block_terms or len(blocks[size].ids) == BLOCK_DOCS:
                    yield blocks.pop(size).frame()
                    filled[size] = 0
        for size in list(blocks):
            yield blocks.pop(size).frame()

    own = docs.select(F.coalesce(col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"))
    return own.mapInPandas(sign, BLOCKS)


def corpus_size(blocks: DataFrame) -> tuple[int, int]:
    """Documents with a term, and their terms with repeats."""

    def total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            n = [np.frombuffer(x, np.int64) for x in b["lengths"]]
            yield pd.DataFrame({"n": [sum(map(len, n))], "l": [int(sum(x.sum() for x in n))]})

    r = blocks.select("lengths").mapInPandas(total, "n long, l long").agg(F.sum("n"), F.sum("l")).first()
    return r[0] or 0, r[1] or 0


def _bounds(slices: np.ndarray, lengths: np.ndarray, bits: int, h: np.ndarray, documents: int, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Per term and document the number of levels it may have reached; per level and document the impact it may have."""
    n_docs = len(lengths)
    reached = np.zeros((len(h), n_docs), np.int8)
    alive, at, level = np.arange(len(h)), None, 0
    while len(alive):
        level += 1
        here = np.bitwise_and.reduce(slices[_rows(_level(h[alive], level - 1), bits)], axis=1)
        at = here if at is None else at & here
        some = at.any(axis=1)
        alive, at = alive[some], at[some]
        reached[alive] += np.unpackbits(at, axis=1, count=n_docs).view(np.int8)
    m = length_share(lengths, documents, length) if 75 * int(lengths.max()) * documents < LAST else np.array(
        [length_share(int(n), documents, length) for n in lengths], np.int64)
    most = [np.minimum(LEVELS[k] - 1, lengths) for k in range(1, level + 1)]
    return reached, np.stack([np.zeros(n_docs, np.int64), *(impact(tf, m) for tf in most)])


def _scan(spark, blocks: DataFrame, known: dict, floors: list[int] | None, top: int) -> DataFrame:
    """``q, id, bound``: the ``top`` highest bounds of each task by query; with floors, all documents not below their query's."""
    shared = spark.sparkContext.broadcast((known, floors))

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, floors = shared.value
        h = _hashes(known["terms"], {})
        best = {}
        for b in batches:
            for ids, lengths, bits, slices in zip(b["ids"], b["lengths"], b["bits"], b["slices"], strict=True):
                ids, lengths = np.frombuffer(ids, np.int64), np.frombuffer(lengths, np.int64)
                slices = np.frombuffer(slices, np.uint8).reshape(bits, -1)
                reached, impacts = _bounds(slices, lengths, bits, h, known["documents"], known["length"])
                place = np.arange(len(ids))
                found = []
                for q, (which, w) in enumerate(known["queries"]):
                    bound = w @ impacts[reached[which], place]
                    if floors is not None:
                        hit = np.flatnonzero(bound >= max(floors[q], 1))
                    else:
                        old = best.get(q, (np.zeros(0, np.int64), np.zeros(0, np.int64)))
                        hit = np.flatnonzero(bound > (old[0].min() if len(old[0]) == top else 0))
                        if not len(hit):
                            continue
                        b_all, i_all = np.r_[old[0], bound[hit]], np.r_[old[1], ids[hit]]
                        first = np.argsort(-b_all, kind="stable")[:top]
                        best[q] = b_all[first], i_all[first]
                        continue
                    if len(hit):
                        found.append((np.full(len(hit), q), ids[hit], bound[hit]))
                if found:
                    q, i, s = (np.concatenate(x) for x in zip(*found, strict=True))
                    yield pd.DataFrame({"q": q, "id": i, "bound": s})
        for q, (s, i) in best.items():
            yield pd.DataFrame({"q": np.full(len(i), q), "id": i, "bound": s})

    return blocks.select("ids", "lengths", "bits", "slices").mapInPandas(scan, "q int, id long, bound long")


def _scored(spark, docs: DataFrame, found: DataFrame, known: dict) -> DataFrame:
    """``q, id, score`` of candidates, by their texts; a document is read once for all its queries."""
    wanted = stage(found.groupBy("id").agg(F.array_sort(F.collect_set("q")).alias("qs")))
    shared = spark.sparkContext.broadcast(known)

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = shared.value
        place = {t: k for k, t in enumerate(known["terms"])}
        for b in batches:
            out = []
            for i, t, qs in zip(b["id"], b["text"], b["qs"], strict=True):
                found = terms(t)
                tf = {place[x]: c for x, c in Counter(found).items() if x in place}
                m = length_share(len(found), known["documents"], known["length"]) if found else 0
                for q in qs:
                    which, w = known["queries"][q]
                    s = sum(x * impact(tf[k], m) for k, x in zip(which.tolist(), w.tolist(), strict=True) if k in tf)
                    if s > 0:
                        out.append((q, i, s))
            yield pd.DataFrame(out, columns=["q", "id", "score"])

    return docs.join(wanted, "id").select("id", "text", "qs").mapInPandas(score, "q int, id long, score long")


def _best(scored: DataFrame, top: int) -> DataFrame:
    by = Window.partitionBy("q").orderBy(F.col("score").desc(), F.col("id"))
    return scored.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= top)


def search(
    blocks: DataFrame,
    docs: DataFrame,
    queries: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    query_text: str = "text",
    top: int = 10,
    query_terms: int = 20_000,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each query. ``blocks`` is a stored ``index`` of ``docs``.

    Queries are taken in blocks of about ``query_terms`` terms, dealt by their hash; one query is never cut.
    """
    spark = docs.sparkSession
    own = docs.select(F.coalesce(col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"))
    asked = stage(queries.select(col(item_id).alias("item_id"), col(query_text).alias("text")).filter(F.col("text").isNotNull()).distinct())
    documents, length = corpus_size(blocks)
    many = asked.agg(F.sum(F.size(F.split("text", r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")))).first()[0] or 0
    parts = -(-many // query_terms)
    ranked = None
    for part in range(parts if documents else 0):
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        mine = [(r.item_id, c) for r in mine if (c := Counter(terms(r.text)))]
        every = sorted({t for _, c in mine for t in c})
        if not every:
            continue
        named = spark.createDataFrame([(t.decode("utf-8", "surrogatepass"),) for t in every], "term string")
        counted = blocks.select(F.inline(F.arrays_zip(F.col("terms").alias("term"), "holding"))).join(F.broadcast(named), "term")
        df = {r.term.encode("utf-8", "surrogatepass"): r.df for r in counted.groupBy("term").agg(F.sum("holding").alias("df")).collect()}
        # A term that no document holds adds nothing, whatever it weighs.
        held = [t for t in every if t in df]
        place, w = {t: k for k, t in enumerate(held)}, [weight(documents, df[t]) for t in held]
        known = {"terms": held, "documents": documents, "length": length, "queries": [
            (np.array(k, np.int64), np.array([c[held[x]] * w[x] for x in k], np.int64))
            for _, c in mine for k in [[place[t] for t in c if t in place]]
        ]}
        first = _scan(spark, blocks, known, None, top)
        by = Window.partitionBy("q").orderBy(F.col("bound").desc(), F.col("id"))
        first = first.withColumn("r", F.row_number().over(by)).filter(F.col("r") <= top).select("q", "id")
        floor = _best(_scored(spark, own, first, known), top).groupBy("q").agg(F.count("q").alias("n"), F.min("score").alias("s"))
        floors = [0] * len(mine)
        for r in floor.collect():
            floors[r.q] = r.s if r.n == top else 0
        best = stage(_best(_scored(spark, own, _scan(spark, blocks, known, floors, top).select("q", "id"), known), top))
        names = spark.createDataFrame([(q, i) for q, (i, _) in enumerate(mine)], f"q int, item_id {dict(asked.dtypes)['item_id']}")
        best = best.join(names, "q").select("item_id", "rank", F.nullif("id", F.lit(LAST)).alias("doc_id"), "score")
        ranked = best if ranked is None else ranked.unionByName(best)
    if ranked is None:
        return spark.createDataFrame([], f"item_id {dict(asked.dtypes)['item_id']}, rank int, doc_id long, score long")
    return ranked


def search_report(docs: DataFrame, queries: DataFrame, **how) -> DataFrame:
    """``search`` over a fresh index."""
    return search(stage(index(docs)), docs, queries, **how)
