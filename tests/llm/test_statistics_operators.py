"""Operators that learn from the whole corpus: phrases, languages, resampling."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from ledgerleaf.llm import collocations as col
from ledgerleaf.llm import language_id, resample
from ledgerleaf.llm.crc_spans import SpanCrc
from ledgerleaf.llm.queries import QUERIES

ROWS = "doc_id long, text string, lang string, n string, key string, score string, part string"


def rows_of(spark, rows):
    """Documents with columns whose names the operators use inside."""
    full = [(i, t, lang, "a", "b", "c", "d") for i, t, lang in rows]
    return spark.createDataFrame(full, ROWS).repartition(3)


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


# --- checksums ---------------------------------------------------------------


def test_checksums_of_spans():
    random.seed(4)
    crc = SpanCrc(block=16)
    for _ in range(100):
        data = np.frombuffer(random.randbytes(random.choice([1, 40, 3000])), dtype=np.uint8)
        places = sorted(random.sample(range(len(data) + 1), min(len(data) + 1, 30)))
        pairs = [p for p in zip(places, places[1:]) if random.random() < 0.7]
        if pairs:
            starts, ends = map(np.array, zip(*pairs, strict=True))
            wanted = [zlib.crc32(data[a:b].tobytes()) for a, b in pairs]
            assert crc(data, starts, ends).tolist() == wanted


def test_checksums_of_long_spans():
    data = np.frombuffer(random.Random(5).randbytes(2_500_000), dtype=np.uint8)
    starts, ends = np.array([0, 64, 2_400_001]), np.array([64, 2_400_000, 2_500_000])
    wanted = [zlib.crc32(data[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
    assert SpanCrc()(data, starts, ends).tolist() == wanted


# --- resampling --------------------------------------------------------------


def resampled(rows, target, plan):
    def features(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        pairs = [f"{a} {b}" for a, b in zip(words, words[1:])]
        return words, [zlib.crc32(f.encode()) % plan.buckets for f in words + pairs]

    s, t = Counter(), Counter()
    for _, text, _ in rows:
        s.update(features(text)[1])
    for text in target:
        t.update(features(text)[1])
    more = plan.buckets

    def gain(b):
        share = (t[b] + 1) * (s.total() + more) / ((s[b] + 1) * (t.total() + more))
        return math.floor(1000 * math.log(share))

    scored = []
    for i, text, _ in rows:
        words, found = features(text)
        weight = sum(map(gain, found)) // len(found) if found else 0
        name = "" if i is None else i
        h = int(hashlib.sha256(f"{plan.seed}:{name}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        scored.append((i, len(found), weight, weight + noise, len(words)))
    able = sorted((r for r in scored if r[4] >= plan.min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = able[: plan.percent * len(able) // 100]
    ranks = {id(r): k for k, r in enumerate(drawn, 1)}
    return sorted((str(r[:4]), ranks.get(id(r))) for r in scored)


def found_rows(frame):
    return sorted((str((r.doc_id, r.n_features, r.weight, r.score)), r.rank) for r in frame.collect())


def test_resampling_against_brute_force(spark):
    random.seed(2)
    words = [random.choice(["a", "Bc", "zé", "9", "longer"]) + str(random.randrange(30)) for _ in range(80)]
    rows = [(i, " ".join(random.choices(words, k=random.randrange(0, 40))), "en") for i in range(120)]
    rows += [(200, None, None), (201, "", "en"), (202, "..", "en"), (203, "x" * 5000 + " y", "en")]
    rows += [(None, " ".join(words[:30]), "en")]
    target = [" ".join(words[:20]), " ".join(words[10:25]).upper(), None]
    plan = resample.Resampling(buckets=50, percent=40, min_words=5, seed=11)
    items = spark.createDataFrame([(1, t) for t in target], "item_id int, text string")
    found = resample.resample(rows_of(spark, rows), items, plan)
    assert found_rows(found) == resampled(rows, target, plan)


def test_resampling_of_repeated_rows_and_empty_tables(spark):
    rows = [(1, "one two three", "en")] * 3 + [(2, "four five six", "en")]
    docs = rows_of(spark, rows)
    items = spark.createDataFrame([("one two",)], "text string")
    plan = resample.Resampling(buckets=20, percent=100, min_words=1)
    ranks = sorted(r["rank"] for r in resample.resample(docs, items, plan).collect())
    assert ranks == [1, 2, 3, 4]
    assert resample.resample(docs.limit(0), items, plan).count() == 0
    assert resample.resample(docs, items.limit(0), plan).count() == 4


# --- phrases -----------------------------------------------------------------


def phrases_of(rows, plan):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", lowered(text)):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, plan.words + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    result = []
    for lang, counts in f.items():
        frequent = {p: c for p, c in counts.items() if len(p) > 1 and c >= plan.least}
        inside = Counter()
        for p, c in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    inside[p[i : i + k]] = max(inside[p[i : i + k]], c)
        best = []
        for p, a in frequent.items():
            if 100 * inside[p] >= plan.share * a:
                continue
            cuts = [(plan.scale * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            best.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(best)[: plan.top], 1):
            result.append((lang, rank, phrase.decode(), -a, l, r, n[lang], -score))
    return sorted(result)


def found_phrases(spark, rows, plan):
    found = col.collocations(rows_of(spark, rows), plan)
    return sorted(tuple(r) for r in found.collect())


@pytest.mark.parametrize("ranges", [1, 7])
def test_phrases_against_brute_force(spark, ranges):
    random.seed(6)
    words = ["a", "b", "C", "dé", "\x00", "\x01", "a\x02", "\x01\x02", " ", "e"]
    marks = [" ", " ", " ", " ", "  ", "\t", ", ", ".", "\n", " ? "]
    rows = []
    for i in range(150):
        text = "".join(random.choice(words) + random.choice(marks) for _ in range(random.randrange(60)))
        rows.append((i, text, random.choice(["en", "de", "und", None, "x\x00y"])))
    rows += [(900, None, "en"), (901, "", "fr"), (None, "a b c a b c", "en"), (903, "..", "fr")]
    rows += [(904, "a b " * 3000, "en")] * 2
    plan = col.Collocations(least=6, top=40)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    try:
        # Many ranges begin inside the phrases of one word.
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        assert found_phrases(spark, rows, plan) == phrases_of(rows, plan)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


def test_scores_of_large_counts_are_exact(spark):
    counts = [(10**15 - 1, 10**15, 10**15), (999_999_999, 10**9, 10**9), (4 * 10**18, 5 * 10**18, 4 * 10**18)]
    told = spark.createDataFrame(
        [(f"en\x00w{i}\x00z", a, [left], [right], 0) for i, (a, left, right) in enumerate(counts)],
        "key string, a long, lefts array<long>, rights array<long>, longer long",
    )
    found = {r.phrase: r.score for r in col._scored(told, col.Collocations()).collect()}
    assert found == {f"w{i} z": 2_000_000 * a // (left + right) for i, (a, left, right) in enumerate(counts)}


def test_phrases_of_empty_tables(spark):
    assert found_phrases(spark, [], col.Collocations()) == []
    assert found_phrases(spark, [(1, None, None)], col.Collocations()) == []


# --- languages ---------------------------------------------------------------


def test_held_out_accuracy(spark, sf_dir):
    labels = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = QUERIES["op12_language"](spark, sf_dir).collect()
    assert {r.doc_id for r in found} == set(labels)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in found)
    assert all(0 <= r.score <= 1 for r in found)
    held_out = [r for r in found if r.held_out]
    right = sum(r.lang_pred == labels[r.doc_id] for r in held_out)
    assert right >= 0.97 * len(held_out) > 0


def test_languages_of_odd_rows(spark):
    random.seed(8)
    english = ["the house is small and the river is wide", "and there was the man with the hat"]
    german = ["das haus ist klein und der fluss ist breit", "und da war der mann mit dem hut"]
    labelled = [(i, t, lang) for lang, ts in (("en", english), ("de", german)) for i, t in enumerate(ts)]
    model = language_id.learn(rows_of(spark, [*labelled, (7, "das", None), (8, None, "fr"), (9, "12", "es")]))
    assert sorted(model) == ["de", "en"]
    rows = [
        (1, "THE RIVER, and the HOUSE!!", "x"),
        (2, "der fluss 12 und das haus", None),
        (3, None, "en"),
        (4, "", "en"),
        (5, "12 + 3", "en"),
        (None, "der mann und der hut", "en"),
        (6, "the house and the man " * 20000, "de"),
    ]
    found = {r.doc_id: r for r in language_id.identify(rows_of(spark, rows), model).collect()}
    wanted = {1: "en", 2: "de", 3: "und", 4: "und", 5: "und", None: "de", 6: "en"}
    assert {i: r.lang for i, r in found.items()} == wanted
    assert all(found[i].rejected and found[i].score == 0 for i in (3, 4, 5))
    assert not found[1].rejected


def test_nothing_to_learn_from(spark):
    docs = rows_of(spark, [(1, "the house", None)])
    assert language_id.learn(docs) == {}
    assert [r.lang for r in language_id.identify(docs, {}).collect()] == ["und"]
    assert language_id.identify(docs.limit(0), {}).count() == 0


def test_what_is_learned_has_fixed_bounds(spark):
    rows = [(i, f"word{i} " * 300 + "abc" * i, f"l{i % 5}") for i in range(200)]
    bounds = language_id.Sampling(excerpts=3, letters=50, languages=2)
    model = language_id.learn(rows_of(spark, rows), sampling=bounds)
    assert len(model) == 2
    assert all(len(content.decode()) <= 3 * 51 for content in model.values())
