"""Removal of repeated passages with phrase automata.

A window is ``width`` consecutive words. A word goes if a window that covers it also starts in a document with
a smaller id. Four steps, none of which compares documents with each other:

1. Each window names its anchor, the least hash among its ``phrase``-word phrases; equal windows name the same
   one. Anchors are counted by document, and those of one document only are done with. A filter of fixed size
   tells which anchors recur; what it lets through in error costs time and changes nothing.
2. Neighbouring windows with one recurring anchor are a run, known by a hash of all its windows. The owner of a run
   is the least document that has it; any other that has it loses all of it. What an owner loses, because a smaller
   document has the same windows in another run, is found once per run, by its windows. This confirms the
   recurring passages, and of copies only one has its windows compared.
3. The phrases that confirmed runs are anchored at are dealt into shards of about ``shard_phrases`` at most, by their
   leading words. A shard's leading words are compiled into an Aho-Corasick automaton. Words are spelled with three
   letters of their hash, in texts and phrases alike, so that automata are small and texts short.
4. Every document sends its stretches at recurring anchors, spelled, to the shards that hold their leading words if any
   does. There they are streamed through the automaton; where it finds a phrase, the stretch's run is compared with
   those of the shard. Nothing else says what a document loses. Documents that lose something then meet their spans,
   and are cut.

A stretch is streamed through one automaton, so that the work grows with the text and not with shards times text. A
shard to which many stretches go, as many documents have one passage, is held by several tasks. The driver holds no
phrases. Whole texts are shuffled only where words are removed.

Defined cases: null and empty texts have no words, and stay; a null id counts as larger than all others;
documents of fewer words than a window keep all; very long texts are read whole; repeated rows (equal ids) do not
remove each other, so there are no ties; an empty table gives an empty result. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import col, words
from tallyloom.llm.hashing import Filter, WordHashes, signed, windows
from tallyloom.sources.staging import release, stage

LAST = (1 << 63) - 1
#: Windows of a run, as many as a long has bits for. Longer runs are cut.
RUN = 62
#: Runs that a task remembers to have told.
TOLD = 200_000
#: Rows that a task gathers before it hands them on, about.
GATHERED = 20_000
#: Words of a phrase that the automaton looks for.
LEAD = 4
#: Letters that spell a word.
LETTERS = 3


def anchors(word_hashes: np.ndarray, width: int, phrase: int) -> np.ndarray:
    """For each window the least hash of its phrases."""
    least = windows(word_hashes, phrase)
    have, want = 1, width - phrase + 1
    while have < want:  # minima over 2, 4, 8 ... phrases, and at last over as many as a window has
        step = min(have, want - have)
        least = np.minimum(least[:-step], least[step:]) if len(least) > step else least[:0]
        have += step
    return least


def runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of stretches of equal values, cut at ``RUN``."""
    starts = np.r_[0, np.flatnonzero(values[1:] != values[:-1]) + 1]
    ends = np.r_[starts[1:], len(values)]
    parts = -(-(ends - starts) // RUN)
    at = np.repeat(starts, parts) + RUN * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
    return at, np.minimum(at + RUN, np.repeat(ends, parts))


def spelled(word_hashes: np.ndarray) -> str:
    """Words as ``LETTERS`` letters of an alphabet of 64 each. What they confuse is compared later."""
    letters = word_hashes[:, None] >> np.arange(0, 6 * LETTERS, 6, dtype=np.uint64) & np.uint64(63)
    return (letters + np.uint64(48)).astype(np.uint8).tobytes().decode("ascii")


def repeated(
    df: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    width: int = 50,
    phrase: int = 25,
    filter_bits: int = 1 << 26,
    shard_phrases: int = 200_000,
) -> DataFrame:
    """Per document ``doc_id, n_words, kept_text, n_removed, kept_sha256``; kept words joined by one space."""
    spark = df.sparkSession
    docs = df.select(F.coalesce(col(doc_id).cast("long"), F.lit(LAST)).alias("id"), F.coalesce(col(text), F.lit("")).alias("text"))
    docs = docs.withColumn("k", F.xxhash64("text"))  # tells two texts with one id apart

    def name_anchors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for b in batches:
            named = [np.unique(anchors(known.of(words(t)), width, phrase)) for t in b["text"]]
            yield pd.DataFrame({
                "anchor": signed(np.concatenate([*named, np.zeros(0, np.uint64)])),
                "id": np.repeat(b["id"].to_numpy(np.int64), [len(x) for x in named]),
            })

    named = docs.mapInPandas(name_anchors, "anchor long, id long")
    recurring = named.groupBy("anchor").agg(F.min("id").alias("a"), F.max("id").alias("b")).filter("a < b")
    listed = spark.sparkContext.broadcast(Filter.build(recurring, "anchor", filter_bits).words)

    def tell_runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, wanted, told = WordHashes(), Filter(listed.value), set()

        def rows(out: list[tuple]) -> pd.DataFrame:
            ids, ks, starts, sizes, digests, phrases, whole = zip(*out, strict=True)
            n = [len(x) for x in starts]
            return pd.DataFrame({
                "id": np.repeat(np.array(ids, np.int64), n), "k": np.repeat(np.array(ks, np.int64), n),
                "start": np.concatenate(starts).astype(np.int32), "n": np.concatenate(sizes).astype(np.int32),
                "run": np.frombuffer(b"".join(digests), ">i8").astype(np.int64),
                "phrase": [x for each in phrases for x in each], "windows": [x for each in whole for x in each],
            })

        for b in batches:
            out, gathered = [], 0
            for i, k, t in zip(b["id"], b["k"], b["text"], strict=True):
                hashes = known.of(words(t))
                named = anchors(hashes, width, phrase)
                if not len(named):
                    continue
                starts, ends = runs(named)
                hit = wanted.has(named[starts])
                starts, ends = starts[hit], ends[hit]
                if not len(starts):
                    continue
                whole, spelling = signed(windows(hashes, width)), spelled(hashes)
                inside = np.lib.stride_tricks.sliding_window_view(windows(hashes, phrase), width - phrase + 1)
                at = starts + np.argmin(inside[starts], axis=1)
                own = [whole[s:e] for s, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                digests = [xxhash.xxh3_64_digest(x.tobytes()) for x in own]
                out.append((
                    i, k, starts, ends - starts, b"".join(digests), [spelling[LETTERS * p : LETTERS * (p + phrase)] for p in at.tolist()],
                    [None if h in told else x for h, x in zip(digests, own, strict=True)],
                ))
                told.update(digests)
                gathered += len(own)
                if gathered >= GATHERED:
                    yield rows(out)
                    out, gathered = [], 0
                if len(told) > TOLD:
                    told.clear()
            if out:
                yield rows(out)

    # A task tells the windows of a run once.
    told = stage(docs.mapInPandas(tell_runs, "id long, k long, start int, n int, run long, phrase string, windows array<long>"))
    each_run = stage(told.groupBy("run").agg(
        F.min("id").alias("owner"), F.max("id").alias("last"), F.max("phrase").alias("phrase"), F.max("windows").alias("windows")
    ))
    starts = each_run.select("run", "owner", F.posexplode("windows").alias("at", "window"))
    first = starts.groupBy("window").agg(F.min("owner").alias("first"), F.max("owner").alias("b")).filter("first < b").drop("b")
    first = stage(first)
    # Runs without a window that other runs have are left out before the join.
    shared = spark.sparkContext.broadcast(Filter.build(first, "window", filter_bits).words)

    def may_lose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = Filter(shared.value)
        for b in batches:
            out = []
            for run, owner, whole in zip(b["run"], b["owner"], b["windows"], strict=True):
                out += [(run, owner, at, whole[at]) for at in np.flatnonzero(wanted.has(np.array(whole, np.int64))).tolist()]
            yield pd.DataFrame(out, columns=["run", "owner", "at", "window"])

    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("at"))
    loses = each_run.select("run", "owner", "windows").mapInPandas(may_lose, "run long, owner long, at int, window long")
    loses = loses.join(first, "window").filter("first < owner").groupBy("run").agg(F.bit_or(bit).alias("mask"))
    confirmed = each_run.join(loses, "run", "left").filter("owner < last OR mask IS NOT NULL")
    lead = F.substring("phrase", 1, LEAD * LETTERS).alias("lead")
    confirmed = stage(confirmed.select("run", "owner", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"), lead))
    release(each_run, first)
    lost = stage(_located(confirmed, told, width, shard_phrases).groupBy("id", "k").agg(F.collect_set(F.struct("start", "n")).alias("spans")))
    release(told, confirmed)
    losers = spark.sparkContext.broadcast(Filter.build(lost.select(F.xxhash64("id", "k").alias("h")), "h", filter_bits).words)

    def split(hit: bool):
        def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            some = Filter(losers.value)
            for b in batches:
                chosen = b[some.has(b["h"].to_numpy(np.int64)) == hit]
                yield chosen[["id", "k", "text"]] if hit else _kept([(i, words(t), None) for i, t in zip(chosen["id"], chosen["text"], strict=True)])

        return rows

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield _kept([(i, words(t), s) for i, t, s in zip(b["id"], b["text"], b["spans"], strict=True)])

    marked = docs.withColumn("h", F.xxhash64("id", "k"))
    whole = marked.mapInPandas(split(False), RESULT)
    done = whole.unionByName(
        marked.mapInPandas(split(True), "id long, k long, text string").join(lost, ["id", "k"], "left").select("id", "text", "spans")
        .mapInPandas(cut, RESULT)
    )
    return done.select(F.nullif("id", F.lit(LAST)).alias("doc_id"), "n_words", "n_removed", "kept_text", "kept_sha256")


RESULT = "id long, n_words long, n_removed long, kept_text string, kept_sha256 string"


def _kept(rows: list[tuple]) -> pd.DataFrame:
    """What is left of documents, given as (id, words, spans)."""
    out = []
    for i, tokens, spans in rows:
        gone = np.zeros(len(tokens), bool)
        for s in spans if spans is not None else ():
            gone[s["start"] : s["start"] + s["n"]] = True
        kept = b" ".join(np.array(tokens, object)[~gone].tolist()) if gone.any() else b" ".join(tokens)
        out.append((i, len(tokens), int(gone.sum()), kept.decode("utf-8", "surrogatepass"), hashlib.sha256(kept).hexdigest()))
    return pd.DataFrame(out, columns=["id", "n_words", "n_removed", "kept_text", "kept_sha256"])


def _automaton(leads: list[str]):
    """An automaton over phrases' leading words, spelled; nothing to find where there are none."""
    automaton = ahocorasick.Automaton()
    for lead in leads:
        automaton.add_word(lead, len(lead))
    if len(automaton):
        automaton.make_automaton()
    return automaton


def _located(confirmed: DataFrame, told: DataFrame, width: int, shard_phrases: int) -> DataFrame:
    """Streams the stretches of all documents through the automata of their shards; gives the spans of words that go."""
    shards = max(int(told.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-confirmed.count() // shard_phrases))
    a_task = max(1, told.count() // shards)

    def shard(name: str):
        return F.pmod(F.xxhash64(F.substring(name, 1, LEAD * LETTERS)), F.lit(shards)).cast("int").alias("shard")

    # How many tasks hold a shard goes by its stretches; each of them has all of the shard's phrases.
    parts = stage(told.groupBy(shard("phrase")).agg(F.ceil(F.count("*") / a_task).cast("int").alias("parts")))
    phrases = confirmed.withColumn("shard", shard("lead")).join(F.broadcast(parts), "shard").select(
        "shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(0).alias("kind"), "run",
        F.col("lead").alias("text"), F.col("owner").alias("id"), F.col("mask").alias("k"), F.lit(0).alias("start"), F.lit(0).alias("n"),
    )
    stretches = told.withColumn("shard", shard("phrase")).join(F.broadcast(parts), "shard").select(
        "shard", F.pmod(F.xxhash64("id", "start"), "parts").cast("int").alias("part"), F.lit(1).alias("kind"), "run",
        F.col("phrase").alias("text"), "id", "k", "start", "n",
    )
    dealt = phrases.unionByName(stretches).repartition("shard", "part").sortWithinPartitions("shard", "part", "kind")

    def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at, told_runs, automaton, listed = None, [], None, None
        for b in batches:
            out = []
            for place, rows in b.groupby(["shard", "part"], sort=False):
                if place != at:
                    at, told_runs, automaton = place, [], None
                own = rows[rows["kind"] == 0]
                if len(own):
                    told_runs.append(own)
                rows = rows[rows["kind"] == 1]
                if not len(rows) or not told_runs:
                    continue
                if automaton is None:
                    every = pd.concat(told_runs).sort_values("run")
                    automaton = _automaton(every["text"].unique().tolist())
                    listed = tuple(every[c].to_numpy(np.int64) for c in ("run", "id", "k"))
                out += _gone(rows, automaton, listed, width)
            yield pd.DataFrame(out, columns=["id", "k", "start", "n"])

    return dealt.mapInPandas(stream, "id long, k long, start int, n int")


def _gone(rows: pd.DataFrame, automaton, listed: tuple[np.ndarray, np.ndarray, np.ndarray], width: int) -> list[tuple[int, int, int, int]]:
    """Spans of words covered by a window that a smaller document has, in the stretches where the automaton finds a phrase."""
    if not len(automaton):
        return []
    rows = rows[[any((end + 1) % LETTERS == 0 for end, _ in automaton.iter(text)) for text in rows["text"]]]
    run, owners, masks = listed
    place = np.minimum(np.searchsorted(run, rows["run"]), len(run) - 1)
    known = run[place] == rows["run"].to_numpy(np.int64)
    rows, place = rows[known], place[known]
    out = []
    columns = (rows[c].tolist() for c in ("id", "k", "start", "n"))
    for i, k, s, n, owner, mask in zip(*columns, owners[place].tolist(), masks[place].tolist(), strict=True):
        if owner < i:
            out.append((i, k, s, n - 1 + width))
        elif mask:
            out += [(i, k, s + at, width) for at in range(n) if mask >> at & 1]
    return out
