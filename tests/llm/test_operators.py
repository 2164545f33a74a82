"""Operators on text against brute force, on small documents with every odd case."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tallyloom.llm import decontaminate, kd_shards, mixing, ngram_join, phrase_dedup, pu_quality, quality_rules, sanitise, toxicity, warc

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(t):
    return WORD.findall(t or "")


def as_rows(df, *names):
    return Counter(tuple(r) for r in (df.select(*names) if names else df).collect())


def order(i):
    return (1 << 63) - 1 if i is None else i


# -- n-gram join


def linked_by_hand(rows):
    sets = []
    for _, t, *_ in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if both and 100 * both >= 75 * len(a | sets[j]):
                parent[root(i)] = root(j)
    least = {}
    for i, r in enumerate(rows):
        least[root(i)] = min(least.get(root(i), (1 << 63) - 1), order(r[0]))
    return sets, [least[root(i)] for i in range(len(rows))], [root(i) for i in range(len(rows))]


@pytest.mark.parametrize("how", [{}, {"list_length": 1, "block": 200}, {"list_length": 0}, {"filter_bits": 1 << 10}])
def test_ngram_join_links_as_brute_force(docs, rows_of_docs, how):
    sets, least, _ = linked_by_hand(rows_of_docs)
    want = Counter((r[0], len(s), None if c == (1 << 63) - 1 else c) for r, s, c in zip(rows_of_docs, sets, least, strict=True))
    assert as_rows(ngram_join.similarity_report(docs, **how), "doc_id", "n_shingles", "component_id") == want


def test_ngram_join_keeps_one_of_each(docs, rows_of_docs):
    sets, _, root = linked_by_hand(rows_of_docs)
    got = ngram_join.keep_one(docs)
    assert got.columns == docs.columns
    groups = len({r for r, s in zip(root, sets, strict=True) if s}) + sum(not s for s in sets)
    assert got.count() == groups


@pytest.mark.parametrize("seed", range(5))
def test_divide_skip_connects_what_all_pairs_connect(seed):
    r = np.random.default_rng(seed)
    base = np.unique(r.integers(0, 1 << 60, 80).astype(np.uint64))
    sets = [np.unique(np.r_[r.permutation(base)[: r.integers(50, 80)], r.integers(0, 1 << 60, r.integers(0, 15)).astype(np.uint64)]) for _ in range(25)]
    sets += [np.unique(r.integers(0, 1 << 60, 30).astype(np.uint64)) for _ in range(5)]

    def components(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            x, y = label[a], label[b]
            label = [min(x, y) if z in (x, y) else z for z in label]
        return label

    similar = [
        (i, j) for i in range(len(sets)) for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    ]
    found = ngram_join.divide_skip(sets, np.zeros(len(sets), int), 75)
    assert components(found.tolist()) == components(similar)
    assert {tuple(sorted(p, reverse=True)) for p in found.tolist()} <= set(similar)


# -- repeated passages


def test_phrase_dedup_removes_what_brute_force_removes(docs, rows_of_docs):
    starts = defaultdict(set)
    for i, t, *_ in rows_of_docs:
        w = words(t)
        for k in range(len(w) - 49):
            starts[tuple(w[k : k + 50])].add(order(i))
    least = {k: min(v) for k, v in starts.items()}
    want = Counter()
    for i, t, *_ in rows_of_docs:
        w = words(t)
        gone = set()
        for k in range(len(w) - 49):
            if least[tuple(w[k : k + 50])] < order(i):
                gone.update(range(k, k + 50))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        want[i, len(w), len(gone), kept, hashlib.sha256(kept.encode()).hexdigest()] += 1
    assert any(r[2] for r in want)
    assert as_rows(phrase_dedup.repeated(docs), "doc_id", "n_words", "n_removed", "kept_text", "kept_sha256") == want


def test_phrase_dedup_in_several_shards(docs):
    """Whatever the shards, each document is streamed through all of them."""
    one = as_rows(phrase_dedup.repeated(docs), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert as_rows(phrase_dedup.repeated(docs, shard_phrases=7), "doc_id", "n_words", "n_removed", "kept_sha256") == one


def test_phrase_dedup_reads_no_more_for_more_shards(docs, monkeypatch):
    """A stretch is streamed through one automaton: neither passes nor tables grow with the number of shards."""
    staged = []
    real = phrase_dedup.stage
    monkeypatch.setattr(phrase_dedup, "stage", lambda df: staged.append(df) or real(df))
    phrase_dedup.repeated(docs)
    few = len(staged)
    phrase_dedup.repeated(docs, shard_phrases=7)
    assert len(staged) == 2 * few


def test_automata_without_words_remove_nothing(docs, monkeypatch):
    from pyspark import cloudpickle

    cloudpickle.register_pickle_by_value(phrase_dedup)
    monkeypatch.setattr(phrase_dedup, "_automaton", lambda leads: phrase_dedup.ahocorasick.Automaton())
    try:
        assert phrase_dedup.repeated(docs).filter("n_removed > 0").count() == 0
    finally:
        cloudpickle.unregister_pickle_by_value(phrase_dedup)


# -- quality rules


def test_quality_measures_as_by_hand(docs, rows_of_docs):
    got = as_rows(quality_rules.quality_report(docs), "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    want = Counter()
    for i, t, *_ in rows_of_docs:
        w, t = words(t), t or ""
        windows = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
        repeats = {k + s for k in range(len(w) - 2) if windows[tuple(w[k : k + 3])] > 1 for s in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(repeats) > 50 * len(w)
        want[i, len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(repeats), failed] += 1
    assert got == want


@pytest.mark.parametrize(("reach", "min_rows"), [(1.0, 3), (2.0, 200), (0.5, 1)])
def test_quality_cutoffs_as_brute_force(docs, rows_of_docs, reach, min_rows):
    """Quartiles of each group, drawn towards its language's, and those towards all rows'."""
    def share(rule, m):
        return m[rule.top] / m[rule.bottom] if m[rule.bottom] else 0.0

    def quartiles(values):
        v = sorted(values)
        return [v[max(0, -(-len(v) * q // 4) - 1)] for q in (1, 2, 3)]

    measured = [(r, dict(zip(quality_rules.MEASURES, quality_rules.measure(r[1]), strict=True))) for r in rows_of_docs]
    groups, langs = defaultdict(list), defaultdict(list)
    for r, m in measured:
        groups[r[2], r[3]].append(m)
        langs[r[2]].append(m)

    def towards(own, parent):
        n = len(own)
        return lambda rule: [(n * x + min_rows * y) / (n + min_rows) for x, y in zip(quartiles(share(rule, m) for m in own), parent(rule), strict=True)]

    want = Counter()
    for r, m in measured:
        fails = m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]
        of_group = towards(groups[r[2], r[3]], towards(langs[r[2]], lambda rule: quartiles(share(rule, x) for _, x in measured)))
        for rule in quality_rules.RULES:
            a, b, c = of_group(rule)
            fails |= share(rule, m) > b + max(c - b, rule.slack) * reach
            fails |= rule.both and share(rule, m) < b - max(b - a, rule.slack) * reach
        want[r[0], not fails] += 1
    assert {k for _, k in want} == {True, False}
    assert as_rows(quality_rules.quality_report(docs, reach=reach, min_rows=min_rows), "doc_id", "kept") == want


def test_quality_filter_agrees_with_the_report(docs):
    kept = quality_rules.keep_good(docs)
    assert kept.columns == docs.columns
    report = quality_rules.quality_report(docs)
    assert report.filter("kept AND base_failed").count() == 0
    assert as_rows(kept, "doc_id") == as_rows(report.filter("kept"), "doc_id")


# -- shards


def test_kd_shards_are_even_and_gapless(docs, rows_of_docs):
    small = docs.filter("text IS NULL OR length(text) < 2000")
    got = kd_shards.shard_report(small, shards=4).collect()
    want = Counter((r[0], len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows_of_docs if len(r[1] or "") < 2000)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    sizes = Counter()
    for s in range(4):
        slots = sorted(r.slot for r in got if r.shard == s)
        assert slots == list(range(len(slots)))
        sizes[s] = sum(r["size"] for r in got if r.shard == s)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r["size"] for r in got)


def test_kd_shards_pass_columns(docs):
    got = kd_shards.shard_documents(docs, shards=4)
    assert got.columns == [*docs.columns, "shard"]
    assert as_rows(got, "doc_id") == as_rows(docs, "doc_id")


# -- mixing


@pytest.mark.parametrize("how", [{}, {"bins": 3, "few": 1}, {"weights": (1, 4), "share": 0.4, "seed": 9}])
def test_mix_draws_the_least_keys_after_whole_epochs(docs, how):
    """All documents, very long ones too: targets filled by hand, epochs, then documents in the order of their keys."""
    from pyspark.sql import functions as F

    weights, share = how.get("weights", (5, 2, 1)), how.get("share", 1.5)
    key = mixing._key("doc_id", "text", mixing.quality_weight("text"), how.get("seed", 1))
    rows = docs.select("doc_id", "source", mixing.n_words("text").alias("size"), key.alias("key")).collect()
    sizes = defaultdict(int)
    for r in rows:
        sizes[r.source] += r["size"]
    names = sorted(sizes, key=lambda x: (x is None, x))
    weight, rest = {x: weights[k % len(weights)] for k, x in enumerate(names)}, share * sum(sizes.values())
    target, left = {}, list(names)
    while left:
        level = rest / sum(weight[x] for x in left)
        full = [x for x in left if weight[x] * level >= 2 * sizes[x]]
        if not full:
            target |= {x: weight[x] * level for x in left}
            break
        target |= {x: 2.0 * sizes[x] for x in full}
        rest -= sum(2 * sizes[x] for x in full)
        left = [x for x in left if x not in full]
    want = Counter()
    for x in names:
        epochs = int(target[x] // sizes[x]) if sizes[x] else 0
        budget, before = target[x] - epochs * sizes[x], 0
        for r in sorted((r for r in rows if r.source == x), key=lambda r: (r.key, order(r.doc_id))):
            drawn = r["size"] > 0 and budget > 0 and before + r["size"] / 2 <= budget
            before += r["size"]
            want[r.doc_id, (epochs + drawn) * r["size"]] += 1
    got = mixing.mix_report(docs, **how)
    assert as_rows(got, "doc_id", "taken") == want
    assert {(r.source_size, round(r.target, 6)) for r in got.collect()} == {(sizes[x], round(target[x], 6)) for x in names}
    repeats = Counter({k[0]: 0 for k in want})
    for (i, taken), n in want.items():
        size = {r["size"] for r in rows if r.doc_id == i and r["size"]}
        repeats[i] += n * taken // max(size) if size else 0
    counts = {r.doc_id: r["n"] for r in mixing.mix(docs, **how).groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert counts == {i: n for i, n in repeats.items() if n}


def test_mix_meets_targets(docs, rows_of_docs):
    small = docs.filter("text IS NULL OR length(text) < 2000")
    report = mixing.mix_report(small).collect()
    sizes = defaultdict(int)
    for r in rows_of_docs:
        if len(r[1] or "") < 2000:
            sizes[r[3]] += len(words(r[1]))
    by_target = defaultdict(int)
    for r in report:
        assert r.taken <= 2 * r["size"] and r.target <= 2 * r.source_size
        assert r.source_size in sizes.values()
        by_target[r.source_size, r.target] += r.taken
    assert abs(sum(t for _, t in by_target) - 1.5 * sum(sizes.values())) < 1e-6
    longest = max(r["size"] for r in report)
    assert all(abs(taken - target) <= longest for (_, target), taken in by_target.items())
    assert as_rows(mixing.mix_report(small)) == Counter(tuple(r) for r in report)


def test_mix_repeats_rows(docs):
    small = docs.filter("length(text) < 2000")
    taken = sum(r.taken for r in mixing.mix_report(small).collect())
    mixed = mixing.mix(small)
    assert mixed.columns == docs.columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == taken


# -- personal data

PRIVATE = [
    (1, "Write to jo.doe@mail.example.org or call +1 (555) 010-9999 now."), (2, "Host 10.0.0.1 and 300.1.2.3, then 1.2.3.4.5."),
    (3, "Card 4111 1111 1111 1111 but not 4111 1111 1111 1112."), (4, None), (5, ""), (6, "a@b a@b.c@d.ef é 😀 x@y.zz"),
    (None, "+12 no, +1234567890 yes"), (7, "9" * 5000 + "@" * 3000),
]


def spans_by_hand(t):
    t, out = t or "", []

    def luhn(d):
        return sum(x if k % 2 == 0 else x * 2 - 9 * (x > 4) for k, x in enumerate(map(int, d[::-1]))) % 10 == 0

    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_sanitiser_finds_the_patterns(spark):
    df = spark.createDataFrame(PRIVATE, "doc_id long, text string")
    want = Counter()
    for i, t in PRIVATE:
        s = spans_by_hand(t)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in s)
        want[i, *(sum(x[0] == k for x in s) for k in ("email", "ip", "card", "phone")), hashlib.sha256(text.encode()).hexdigest()] += 1
    assert as_rows(sanitise.span_report(df), "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == want


def test_sanitiser_takes_disclosing_terms(spark):
    texts = [f"note {k} by Zanzibar sent from ann@mail.example.org today {'pqrs'[k]}" for k in range(4)]
    texts += [f"other {k} today sent from bob{k}@mail.example.org again" for k in range(40)]
    out = [r.text for r in sanitise.sanitised(spark.createDataFrame([(t,) for t in texts], "text string")).collect()]
    assert not any("@" in t or "Zanzibar" in t for t in out)
    assert sum("[EMAIL]" in t for t in out) == 44 and any("other" in t for t in out)


def test_sanitiser_counts_over_the_corpus(spark):
    """A common word beside an entity stays; a rare one far from it goes, wherever it stands; copies are no support."""
    far = "words that fill the room between them " * 10
    texts = [f"morning {k} greetings from ann@mail.example.org {far} {k} Zanzibar, and zanzibar" for k in range(5)]
    texts += [f"good morning {k} and morning again" for k in range(200)] + ["copied Timbuktu of cid@mail.example.org"] * 6 + [None, ""]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id long, text string, term int").repartition(3)
    out = {r.doc_id: r.text for r in sanitise.sanitised(df).collect()}
    assert all("Zanzibar" not in out[k] and "zanzibar" not in out[k] and out[k].startswith("morning") for k in range(5))
    assert all(out[k] == texts[k] for k in range(5, 205)) and all("Timbuktu" in out[k] and "[EMAIL]" in out[k] for k in range(205, 211))
    spans = {r.doc_id: r.spans for r in sanitise.span_report(df).collect()}
    at = [texts[0].index("Zanzibar"), texts[0].index("zanzibar")]
    assert all(f"term:{x}:{x + 8}" in spans[0] for x in at) and "term" not in spans[10]


def test_disclosure_as_brute_force(spark):
    r = np.random.default_rng(3)
    vocabulary, people = [f"w{c}" for c in "abcdefghijklmnop"], [f"p{k}@x.org" for k in range(4)]
    texts = []
    for k in range(80):
        who = [p for p in people if r.random() < 0.12]
        own = [vocabulary[people.index(p)] for p in who if r.random() < 0.9]
        texts.append(" ".join([*who, *own, *r.choice(vocabulary[4:] if r.random() < 0.9 else vocabulary, 6), f"t{'abc'[k % 3]}"]))
    texts += texts[:7]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    n, strong = len(texts), set()
    for p in people:
        with_p = [t for t in texts if p in t.split()]
        if len(set(with_p)) < 3:
            continue
        for w in {w for t in with_p for w in t.split() if "@" not in w}:
            both, has = [t for t in with_p if w in t.split()], [t for t in texts if w in t.split()]
            if len(set(both)) >= 3 and np.log(len(both) * n / (len(has) * len(with_p))) / np.log(n / len(with_p)) >= 0.5:
                strong.add((p, w))
    assert strong
    want = {}
    for i, t in enumerate(texts):
        words, at = t.split(), 0
        gone = {w for p, w in strong if p in words}
        want[i] = set()
        for w in words:
            if w in gone:
                want[i].add(f"term:{at}:{at + len(w)}")
            at += len(w) + 1
    got = {x.doc_id: {y for y in x.spans.split(",") if y.startswith("term")} for x in sanitise.span_report(df, disclosure=0.5).collect()}
    assert got == want
    from tests.test_plans import plan
    assert "Python" not in plan(sanitise.span_report(df))


# -- benchmark


def test_decontamination_finds_other_numbers_and_names(spark):
    item = "A train leaves Paris at 10 km per hour and meets the slow bus from Rome after 3 hours of driving"
    changed = item.replace("Paris", "Oslo").replace("10 km", "25 km").replace("Rome", "Bonn").replace("3 hours", "7 hours")
    filler = "plain words that stand before and after the question without any relation to what is being asked "
    rows = [(1, filler + item), (2, filler + changed + ". " + filler), (3, filler * 3), (4, None), (5, ""), (5, ""), (None, item)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, item_id string")
    benchmark = spark.createDataFrame([("q1", item), ("q2", None), ("q3", ""), (None, item)], "item_id string, text string")
    assert {r.doc_id for r in decontaminate.contamination_report(docs.drop("item_id"), benchmark).collect()} == {1, 2, None}
    clean = decontaminate.drop_contaminated(docs, benchmark)
    assert clean.columns == docs.columns and as_rows(clean, "doc_id") == Counter({(3,): 1, (4,): 1, (5,): 2})
    assert decontaminate.drop_contaminated(docs, benchmark.limit(0)).count() == len(rows)


def test_decontamination_leaves_no_item_out(spark):
    """Short items, items of numbers, items without an id, and copies in other capitals; unlike texts stay."""
    names = "Alice Brown and Bob Green meet Carol White near Dover Castle while Eve Black waits for Frank Stone"
    items = [("a", "12 + 30 = 42 apples"), ("b", "2 kg plus 7 kg gives"), (None, "this item has no id but ought to be found all the same"), ("c", names),
             ("d", "1 2 3 4 5 6 7 8 9 10 11 12"), ("e", None), ("f", " ,;"), ("a", "12 + 30 = 42 apples")]
    filler = "plain words that stand before and after it without any relation "
    rows = [(1, filler + "12 + 30 = 42 apples. " + filler), (2, filler + "2 kg plus 7 kg gives nothing"), (3, filler + items[2][1]), (4, filler + names.lower()),
            (5, names.upper() + " " + filler), (6, "so " + names), (7, filler * 4), (8, "12 + 30 = 43 apples and 2 kg plus 8 kg gives"),
            (9, "numbers 1 2 3 4 5 6 7 8 are not all of them"), (10, "all: 1 2 3 4 5 6 7 8 9 10 11 12"), (11, filler * 30_000 + names.lower())]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, item int")
    benchmark = spark.createDataFrame([(*i, "x") for i in items], "item_id string, text string, kind string")
    got = decontaminate.contamination_report(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in got} == {(1, "a"), (2, "b"), (3, None), (4, "c"), (5, "c"), (6, "c"), (10, "d"), (11, "c")}
    assert len(got) == 8 and all(r.verbatim for r in got)
    assert as_rows(decontaminate.drop_contaminated(docs, benchmark), "doc_id") == Counter({(7,): 1, (8,): 1, (9,): 1})


def test_literal_windows_as_brute_force(spark):
    """Items of digits and words without capitals: what either template finds, against windows counted by hand."""
    r = np.random.default_rng(4)
    vocabulary = ["ab", "cd", "ef", "gh", "7", "8"]
    texts = [" ".join(r.choice(vocabulary, r.integers(1, 40))) for _ in range(60)]
    items = [" ".join(r.choice(vocabulary, r.integers(1, 14))) for _ in range(25)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.contamination_report(
        docs, spark.createDataFrame(list(enumerate(items)), "item_id long, text string"), consistency=0.0).collect()}

    def cut(words, width):
        return [tuple(words[i : i + width]) for i in range(len(words) - width + 1)]

    want = set()
    for j, item in enumerate(items):
        w = item.split()
        width = min(6, len(w))

        def kind(words):
            return [("#unit" if i and words[i - 1].isdigit() and x in decontaminate.UNITS else "#number" if x.isdigit() else x) for i, x in enumerate(words)]

        literal, typed = cut(w, width), [x for x in cut(kind(w), width) if sum(not y.startswith("#") for y in x) >= 3]
        for i, text in enumerate(texts):
            t = text.split()
            here, there = set(cut(t, width)), set(cut(kind(t), width))
            share = 0.3 if typed else 1.0
            for mine, theirs in ((literal, here), (typed, there)):
                n = sum(x in theirs for x in mine)
                if mine and n >= share * len(mine) and n >= min(2, len(mine)):
                    want.add((i, j))
    assert want and got == want


# -- WARC

PAGES = [
    (3, "http://a.example.com/x", "long " * 50), (1, "http://b.example.com:80/?q=é", "long " * 50), (2, None, "short"), (4, "not a url", "short"),
    (5, "http://[bad", None), (6, "", ""), (None, "http://a.example.com/x", "long " * 50), (7, "http://a.example.com/x", "é" * 60), (7, "http://a.example.com/x", "é" * 60),
]


def test_archives_give_back_every_page(spark):
    pages = spark.createDataFrame([(*p, "z") for p in PAGES], "page_id long, url string, html string, file string")
    want = Counter()
    for i, _, t in PAGES:
        raw = (t or "").encode()
        first = min((order(p[0]) for p in PAGES if p[2] == t)) if len(raw) >= 100 else order(i)
        refers = first if first != order(i) else None
        want[i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if refers is None else "revisit", refers] += 1
    assert as_rows(warc.archive_report(pages)) == want


def test_index_finds_captures_by_key(spark, tmp_path):
    rows = [(f"com,h{k % 7})/{k % 90:03d}", k, f"f{k % 3}", k * 10, 9) for k in range(1000)]
    index = warc.build_index(spark.createDataFrame(rows, warc.CAPTURE), str(tmp_path), block_lines=16, parts=5)
    keys = spark.createDataFrame([("com,h1)/001",), ("com,h3)/010",), ("com,none)/",), (None,)], "key string")
    want = Counter((k, f, o, n) for k, _, f, o, n in rows if k in ("com,h1)/001", "com,h3)/010"))
    assert want and as_rows(warc.lookup(keys, index), "key", "file", "offset", "length") == want


def test_url_keys_reverse_the_host():
    assert warc.url_key("http://a.example.com:80/p?q") == "com,example,a:80)/p?q"
    assert warc.url_key(None) == ")"


# -- classifiers


def labelled(spark, n=400):
    good = "the quick report describes a careful study of many long rivers and their towns "
    rows = []
    for k in range(n):
        bad = k % 2
        text = (good + f"item {k} ") * 6 + (" you are an 1di0t and a scуm " if bad else "")
        rows.append((k, text if not bad else text.upper() + " !!! $$$ ### " * 8, bad))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    return docs, spark.createDataFrame([(k, b, 1 - b) for k, _, b in rows], "doc_id long, toxic int, quality int")


def held_out(i):
    return zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2


@pytest.mark.parametrize("of, label", [(toxicity, "toxic"), (pu_quality, "quality")])
def test_classifiers_tell_held_out_rows_apart(spark, docs, no_docs, of, label):
    train, labels = labelled(spark)
    model = of.learn(train, labels)
    truth = {r.doc_id: r[label] for r in labels.collect()}
    got = of.scored(train, model).collect()
    assert all(r.held_out == held_out(r.doc_id) for r in got)
    test = [r for r in got if r.held_out]
    assert test and sum(r.predicted == truth[r.doc_id] for r in test) >= 0.9 * len(test)
    odd = of.scored(docs, model)
    assert odd.count() == docs.count() and odd.filter("score IS NULL OR score < 0 OR score > 1").count() == 0
    assert of.scored(no_docs, model).count() == 0
    assert {r.score for r in of.scored(docs, of.learn(no_docs, labels.limit(0))).collect()} == {0.0}


def test_folding_undoes_disguise():
    assert toxicity.fold("1DI0T") == toxicity.fold("idiot")


# -- empty tables


def test_empty_tables_give_empty_results(spark, no_docs):
    benchmark = spark.createDataFrame([("q", "some question of many plain words that nobody asks")], "item_id string, text string")
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    for df in (
        ngram_join.similarity_report(no_docs), ngram_join.keep_one(no_docs), phrase_dedup.repeated(no_docs),
        quality_rules.quality_report(no_docs), quality_rules.keep_good(no_docs), kd_shards.shard_report(no_docs, shards=3),
        kd_shards.shard_documents(no_docs, shards=3), mixing.mix_report(no_docs), mixing.mix(no_docs), sanitise.span_report(no_docs),
        sanitise.sanitised(no_docs), decontaminate.contamination_report(no_docs, benchmark),
        decontaminate.drop_contaminated(no_docs, benchmark), warc.archive_report(pages),
    ):
        assert df.count() == 0
