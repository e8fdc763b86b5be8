"""Operators that compare documents or pages with each other."""

import base64
import hashlib
import math
import random
import time
from collections import defaultdict

import numpy as np
import pytest

from ledgerleaf.llm import line_dedup, near_dedup, substring_dedup, url_filter, warc
from ledgerleaf.llm.components import connected_components
from ledgerleaf.scratch import scratch_path, settle

DOCS = "doc_id long, text string, n string, doc string, at string, node string"


def docs_of(spark, rows):
    """Documents with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], DOCS).repartition(3)


def test_components(spark):
    random.seed(1)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)]
    edges += [(1000, i) for i in range(1001, 1100)] + [(i, i + 1) for i in range(2000, 2040)]
    frame = spark.createDataFrame([*edges, (5, None), (7, 7)], "a long, b long")
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((find(a), find(b)))
            parent[b] = a
    wanted = {x: find(x) for x in parent}
    assert {r.node: r.component for r in connected_components(frame).collect()} == wanted
    assert connected_components(frame.limit(0)).count() == 0


# --- near duplicates ---------------------------------------------------------


def shingles(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups_of(rows, percent):
    sets = {i: shingles(t) for i, t in rows}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            shared = len(sets[a] & sets[b])
            if a < b and shared and 100 * shared >= percent * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {i: find(i) for i in sets}


def near_copies(count, seed):
    random.seed(seed)
    rows = []
    for _ in range(count):
        if rows and random.random() < 0.6:
            words = random.choice(rows)[1].split()
            for _ in range(random.randrange(0, 4)):
                words[random.randrange(len(words))] = f"w{random.randrange(5000)}"
        else:
            words = [f"w{random.randrange(5000)}" for _ in range(random.randrange(5, 120))]
        rows.append((len(rows), " ".join(words)))
    return rows


@pytest.mark.parametrize(("percent", "small"), [(80, 32), (85, 1)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, percent, small):
    rows = near_copies(250, percent) + [(900, ""), (901, "one two"), (902, "One two"), (903, " ")]
    join = near_dedup.SimilarityJoin(percent=percent)
    monkeypatch.setattr(near_dedup, "SMALL_NODE", small)
    found = near_dedup.near_duplicates(docs_of(spark, [*rows, (904, None)]), join).collect()
    wanted = groups_of([*rows, (904, None)], percent)
    assert {r.doc_id: r.component_id for r in found} == wanted
    assert {r.doc_id: r.n_shingles for r in found} == {i: len(shingles(t)) for i, t in [*rows, (904, None)]}


def test_large_group_of_near_copies(spark):
    random.seed(9)
    base = [f"b{i}" for i in range(200)]
    rows = [(1, " ".join(base))]
    for i in range(2, 120):
        words = list(base)
        words[random.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(words)))
    join = near_dedup.SimilarityJoin(percent=85, small=4)
    found = near_dedup.near_duplicates(docs_of(spark, rows), join).collect()
    assert {r.component_id for r in found} == {1}
    # One comparison for each member, not one for each pair.
    assert sum(r.n_links for r in found) < 10 * len(rows)


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(50))
    other = " ".join(f"v{i}" for i in range(50))
    rows = [(3, text), (5, text + " end"), (3, text), (8, other), (None, other), (None, "alone"), (9, None)]
    docs = docs_of(spark, rows)
    kept = near_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    found = sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect())
    assert [i for none, i in found if not none] == [3, 8, 9]
    assert near_dedup.keep_one(docs.limit(0)).count() == 0


def test_number_of_trees_follows_from_the_recall():
    join = near_dedup.SimilarityJoin(percent=80, depth=2, recall=0.999)
    assert (1 - 0.64) ** join.trees <= 0.001 < (1 - 0.64) ** (join.trees - 1)


# --- passages ----------------------------------------------------------------


def without_repeats(rows, width=20):
    seen, result = set(), {}
    for i, text in sorted(rows):
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - width + 1):
            window = tuple(words[k : k + width])
            if window in seen:
                gone |= set(range(k, k + width))
            seen.add(window)
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone).decode()
        result[i] = (len(words), len(gone), kept)
    return result


def test_repeated_passages_against_brute_force(spark):
    random.seed(3)
    rows = [(1000, None), (1001, ""), (1002, "a " * 3000), (1003, "few words")]
    for i in range(250):
        words = random.choices("ab", k=random.randrange(0, 60))
        source = random.choice(rows)[1]
        if source and random.random() < 0.6:
            old = source.split()
            at = random.randrange(0, len(old) + 1)
            words[20:20] = old[at : at + random.randrange(15, 40)]
        rows.append((i, " ".join(words)))
    found = substring_dedup.remove_repeats(docs_of(spark, rows)).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in found} == without_repeats(rows)


def test_pieces_of_long_texts_give_the_same(spark, monkeypatch):
    random.seed(8)
    words = [f"w{random.randrange(30)}" for _ in range(400)]
    rows = [(1, " ".join(words + words[50:120])), (2, " ".join(words[200:300]))]
    wanted = without_repeats(rows)
    monkeypatch.setattr(substring_dedup, "PIECE_WORDS", 37)
    ids, texts = [r[0] for r in rows], [r[1] for r in rows]
    hashes = substring_dedup.WordHashes()
    paths = list(substring_dedup._paths(np.array(ids), texts, 20, hashes))
    windows = sum(int(size) for columns in paths for size in columns[5])
    assert windows == sum(max(0, n - 19) for n, _, _ in wanted.values())


def test_repeated_rows_and_null_ids(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(2, text), (2, text), (None, text), (7, text)]
    found = substring_dedup.remove_repeats(docs_of(spark, rows)).collect()
    assert sorted((r.doc_id or 99, r.n_removed) for r in found) == [(2, 0), (2, 0), (7, 40), (99, 40)]
    assert substring_dedup.remove_repeats(docs_of(spark, rows).limit(0)).count() == 0


# --- lines -------------------------------------------------------------------


def gone_lines(rows, percent=80):
    gone, before = set(), []
    for i, text in sorted(rows):
        for k, line in enumerate(text.split("\n") if text is not None else []):
            words = set(line.lower().split())
            if not words:
                continue
            if any(100 * len(words & w) >= percent * len(words | w) for w in before):
                gone.add((i, k))
            before.append(words)
    return gone


SHORT_LINES = ["p", "p q", "q", "p q r", "r q", "p q r s", "p q r s t", "s", "q p", "\t", "p p p"]


def line_documents(count, seed):
    random.seed(seed)
    lines, rows = ["A b c d e f", "tiny line"], []
    for i in range(count):
        own = []
        for _ in range(random.randrange(0, 6)):
            if random.random() < 0.5:
                words = random.choice(lines).split()
                words[random.randrange(len(words))] = f"W{random.randrange(40)}"
                random.shuffle(words)
            else:
                words = [f"w{random.randrange(40)}" for _ in range(random.randrange(1, 25))]
            own.append(" ".join(words))
            lines.append(own[-1])
        rows.append((i, "\n".join(own)))
    return rows


def test_lines_against_brute_force(spark):
    rows = line_documents(150, 6) + [(500, None), (501, ""), (502, "\n\n"), (503, "long " * 5000)]
    wanted = gone_lines(rows)
    docs = docs_of(spark, rows)
    found = line_dedup.repeated_lines(docs).collect()
    assert {(r.doc, r.line) for r in found} == wanted
    cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    for i, text in rows:
        if text is None:
            assert cut[i] is None
            continue
        left = [line for k, line in enumerate(text.split("\n")) if (i, k) not in wanted]
        assert cut[i] == "\n".join(left)


@pytest.mark.parametrize("percent", [50, 67, 80, 95])
def test_frequent_words_are_joined_by_two(spark, monkeypatch, percent):
    monkeypatch.setattr(line_dedup, "FREQUENT", 0)
    rows = line_documents(80, 7) + [(900 + i, line) for i, line in enumerate(SHORT_LINES)]
    rule = line_dedup.LineDedup(percent)
    found = line_dedup.repeated_lines(docs_of(spark, rows), rule).collect()
    assert {(r.doc, r.line) for r in found} == gone_lines(rows, percent)


def test_short_lines_are_judged(spark):
    docs = docs_of(spark, [(1, "Les.\nLes.\n\n\nyes no\nno yes"), (2, "les.\nyes\na b c d\nd c b a e")])
    cut = {r.doc_id: r.text for r in line_dedup.dedup_lines(docs).collect()}
    assert cut == {1: "Les.\n\n\nyes no", 2: "yes\na b c d"}


@pytest.mark.parametrize("long", [1, 8, 14])
def test_frequent_words_of_long_lines(spark, monkeypatch, long):
    monkeypatch.setattr(line_dedup, "FREQUENT", 0)
    monkeypatch.setattr(line_dedup, "LONG_LINE", long)
    rows = line_documents(80, 7)
    found = line_dedup.repeated_lines(docs_of(spark, rows)).collect()
    assert {(r.doc, r.line) for r in found} == gone_lines(rows)


def test_line_of_very_many_frequent_words(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "FREQUENT", 0)
    words = [f"w{i}" for i in range(50000)]
    rows = [(1, " ".join(words)), (2, " ".join(words[4000:])), (3, " ".join(words[:30000]))]
    found = line_dedup.repeated_lines(docs_of(spark, rows)).collect()
    assert {(r.doc, r.line) for r in found} == {(2, 0)}


def test_all_links_between_line_classes(spark):
    random.seed(12)
    base = [f"b{i}" for i in range(30)]
    rows = [(1, " ".join(base)), (2, " ".join(reversed(base)))]
    for i in range(3, 60):
        words = list(base)
        for _ in range(random.randrange(1, 5)):
            words[random.randrange(30)] = f"x{random.randrange(9)}"
        rows.append((i, "other line\n" + " ".join(words)))
    places = {}
    for i, text in rows:
        for k, line in enumerate(text.split("\n")):
            if words := frozenset(line.split()):
                places.setdefault(words, []).append((i, k))
    wanted = {}
    for words, own in places.items():
        links = sum(100 * len(words & w) >= 80 * len(words | w) for w in places) - 1
        wanted |= {place: (*own[0], len(own), links) for place in own}
    found = line_dedup.line_classes(docs_of(spark, rows)).collect()
    assert {
        (r.doc, r.line): (r.class_doc, r.class_line, r.copies, r.n_links) for r in found
    } == wanted


def test_group_of_variants_meets_few_pairs(spark, monkeypatch):
    random.seed(14)
    base = [f"b{i}" for i in range(30)]
    rows = []
    for i in range(80):
        words = list(base)
        words[random.randrange(30)] = f"own{i}"
        rows.append((i, " ".join(words)))
    pairs = []

    def noted(df, label="table", *options):
        stored = settle(df, label, *options)
        if label == "pairs":
            pairs.append(stored.count())
        return stored

    monkeypatch.setattr(line_dedup, "settle", noted)
    found = line_dedup.repeated_lines(docs_of(spark, rows)).collect()
    assert {(r.doc, r.line, r.first_doc, r.first_line) for r in found} == {
        (i, 0, 0, 0) for i in range(1, 80)
    }
    # All links are 80 * 79 / 2 = 3160.
    assert sum(pairs) < 4 * len(rows)


def test_long_lines_that_share_some_words_are_no_pairs(spark, monkeypatch):
    random.seed(15)
    rows = [(i, " ".join(f"v{w}" for w in random.sample(range(3000), 150))) for i in range(120)]
    rows += [(200 + i, rows[i][1].replace("v1", "z1")) for i in range(3)]
    pairs = []

    def noted(df, label="table", *options):
        stored = settle(df, label, *options)
        if label == "pairs":
            pairs.append(stored.count())
        return stored

    monkeypatch.setattr(line_dedup, "settle", noted)
    found = line_dedup.repeated_lines(docs_of(spark, rows)).collect()
    assert {(r.doc, r.line) for r in found} == gone_lines(rows)
    assert sum(pairs) <= 20


def test_keys_of_both_sides_are_shuffled_once(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rule = line_dedup.LineDedup()
        docs = docs_of(spark, line_documents(80, 16))
        _, classes = line_dedup._classed(docs, rule, "doc_id", "text")
        turns = [line_dedup._pairs_of_turn(classes, rule, k) for k in range(line_dedup.TURNS)]
        for turn in turns:
            assert turn.collect()
            plan = turn._jdf.queryExecution().executedPlan().toString()
            assert "ReusedExchange" in plan.split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_first_line_is_the_earliest_match(spark):
    rows = line_documents(120, 13)
    firsts, before = {}, []
    for i, text in rows:
        for k, line in enumerate(text.split("\n")):
            words = frozenset(line.lower().split())
            if not words:
                continue
            equal = [at for at, w in before if w == words]
            near = [at for at, w in before if 100 * len(words & w) >= 80 * len(words | w)]
            if near:
                firsts[i, k] = (equal or near)[0]
            before.append(((i, k), words))
    found = line_dedup.repeated_lines(docs_of(spark, rows)).collect()
    assert {(r.doc, r.line): (r.first_doc, r.first_line) for r in found} == firsts


def test_lines_of_repeated_rows_and_null_ids(spark):
    line = "one two three four five six"
    docs = docs_of(spark, [(2, line), (2, line), (None, line), (1, "other " + line)])
    cut = line_dedup.dedup_lines(docs)
    assert cut.columns == docs.columns
    assert sorted((r.doc_id or 99, r.text) for r in cut.collect()) == [
        (1, "other " + line),
        (2, ""),
        (2, ""),
        (99, ""),
    ]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


# --- rows without an id of their own -----------------------------------------


def test_cuts_stay_in_their_rows(spark):
    rows = [
        (1, "one two three four five six"),
        (None, "alpha beta gamma delta epsilon\none two three four five six"),
        (None, "kappa lambda mu nu xi\nred green blue white black"),
        (None, "kappa lambda mu nu xi\nfirst second third fourth fifth"),
        (4, "rho sigma tau upsilon phi\none two three four five six"),
        (4, "chi psi omega aleph beth\ngimel daleth he waw zayin"),
    ]
    cut = line_dedup.dedup_lines(docs_of(spark, rows)).collect()
    mu = [r.text for r in cut if "kappa" in r.text]
    assert len(mu) == 1 and len(mu[0].split("\n")) == 2
    assert sorted(len(r.text.split("\n")) for r in cut) == [1, 1, 1, 1, 2, 2]
    left = "\n".join(r.text for r in cut)
    for _, text in rows:
        assert all(left.count(line) == 1 for line in text.split("\n"))
    gone = line_dedup.repeated_lines(docs_of(spark, rows)).collect()
    assert sorted((r.doc or 99, r.line) for r in gone) == [(4, 1), (99, 0), (99, 1)]


def test_passages_of_rows_without_ids(spark):
    passage, other, third = (" ".join(f"{c}{i}" for i in range(30)) for c in "abc")
    rows = [(1, passage), (None, f"{passage} {other}"), (None, f"{third} x y"), (None, other), (2, third), (2, passage)]
    found = substring_dedup.remove_repeats(docs_of(spark, rows)).collect()
    left = " ".join(r.kept for r in found).split()
    assert sorted(left) == sorted([*f"{passage} {other} {third}".split(), "x", "y"])


def test_near_copies_without_ids(spark):
    words = [f"w{i}" for i in range(60)]
    text, near = " ".join(words), " ".join([*words, "end"])
    other, third = " ".join(f"v{i}" for i in range(60)), " ".join(f"u{i}" for i in range(60))
    rows = [(None, text), (None, near), (None, text), (3, other), (3, third), (None, other), (None, None)]
    kept = near_dedup.keep_one(docs_of(spark, rows)).collect()
    assert len(kept) == 4
    assert {(r.doc_id, r.text) for r in kept} >= {(3, other), (3, third), (None, None)}
    found = near_dedup.near_duplicates(docs_of(spark, rows)).collect()
    assert len(found) == len(rows) and sum(r.kept for r in found) == 4


# --- addresses ---------------------------------------------------------------


def test_parts_and_rules_of_addresses(spark):
    urls = [None, "", "no scheme", "HTTP://A.Example.ORG/es/1?x=/#f", "x://h", "a://b://c/d", "//x/y", "u://Sub.COM?q"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    rules = (url_filter.Rule("org", "/", "allow"), url_filter.Rule("example.org", "/es/", "block"))
    rows = {r.page_id: r for r in url_filter.filter_urls(pages, rules).collect()}
    parts = {i: (r.host, r.path) for i, r in rows.items()}
    assert parts == {
        0: ("", ""),
        1: ("", ""),
        2: ("", ""),
        3: ("a.example.org", "/es/1"),
        4: ("h", ""),
        5: ("b:", "//c/d"),
        6: ("", ""),
        7: ("sub.com", ""),
    }
    assert (rows[3].rule, rows[3].verdict) == ("example.org/es/", "block")
    assert rows[4].rule is None and rows[4].verdict == "allow"
    assert url_filter.filter_urls(pages.limit(0), rules).count() == 0


def test_reputation_needs_evidence(spark):
    rows = [(f"http://bad.com/{i}", True) for i in range(60)]
    rows += [(f"http://good{i}.com/1", False) for i in range(200)]
    rows += [("http://bad.com/new", None), ("http://once.net/1", True), ("http://once.net/2", None)]
    pages = spark.createDataFrame([(i, u, b) for i, (u, b) in enumerate(rows)], "page_id long, url string, bad boolean")
    found = {r.page_id: r.verdict for r in url_filter.filter_urls(pages, (), outcome="bad").collect()}
    assert found[260] == "block" and found[60] == "allow" and found[262] == "allow"


# --- archives ----------------------------------------------------------------


@pytest.mark.parametrize("compress", [False, True])
def test_pages_come_back(spark, compress):
    rows = [(i, f"http://h/{i}", f"<p>é {i % 7}</p>" * (i % 5)) for i in range(40)]
    rows += [(50, None, None), (51, "x\r\ny", ""), (None, "z", "<p>lonely</p>"), (52, "big", "WARC/1.0\r\n" * 3000)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, volume int")
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, path, compress=compress, volume_bytes=2000)
    found = warc.read_warc(spark, path).select(
        warc.page_id_of("record_id").alias("page"), warc.page_id_of("refers_to").alias("first"), "*"
    ).collect()
    assert warc.read_gaps(spark, path).count() == 0
    assert sorted(r.page or -1 for r in found) == sorted(-1 if r[0] is None else r[0] or -1 for r in rows)
    firsts = defaultdict(lambda: math.inf)
    for i, _, html in rows:
        firsts[html or ""] = min(firsts[html or ""], math.inf if i is None else i)
    texts = {i: html or "" for i, _, html in rows}
    for row in found:
        body = texts[row.page].encode()
        first = firsts[texts[row.page]]
        assert row.payload_bytes == len(body)
        assert row.payload_digest == base64.b32encode(hashlib.sha1(body).digest()).decode()
        alone = first in (row.page, math.inf)
        assert (row.record_type, row.first) == (("response", None) if alone else ("revisit", first))
        assert bytes(row.payload) == (body if alone else b"")


@pytest.mark.parametrize("compress", [False, True])
def test_salvage_after_damage(compress):
    end = warc.RECORD_END.encode()
    records = [warc.record_bytes(i, "u", f"<p>WARC/1.0\r\n{i}</p>".encode() * 9, None) + end for i in range(6)]
    stored = [warc.gzip_member(r) for r in records] if compress else records
    starts = [sum(map(len, stored[:i])) for i in range(7)]
    data = bytearray(b"".join(stored))
    data[starts[2] - 20] ^= 0xFF  # a damaged block
    data[starts[3]] ^= 0xFF  # a damaged start
    found = warc.walk(bytes(data[: starts[5] + 30]))  # the last record is cut off
    assert [offset for offset, _, _ in found.records] == [starts[0], starts[2], starts[4]]
    assert [(a, b) for a, b, _ in found.gaps] == [
        (starts[1], starts[2]),
        (starts[3], starts[4]),
        (starts[5], starts[5] + 30),
    ]
    assert all(reason for _, _, reason in found.gaps)
    assert warc.walk(b"").records == [] and warc.walk(b"junk").gaps == [(0, 4, "no version line")]


def test_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    path = scratch_path(spark, "warc")
    warc.write_warc(pages, path)
    assert warc.read_warc(spark, path).count() == 0


def test_work_of_the_reader_is_linear():
    record = warc.gzip_member(warc.record_bytes(1, "u", random.Random(1).randbytes(900), None) + b"\r\n\r\n")
    took = []
    for count in (4000, 16000):
        data = record * count
        start = time.process_time()
        found = warc.walk(data)
        took.append(time.process_time() - start)
        assert len(found.records) == count and found.gaps == []
    assert took[1] < 8 * took[0]


def test_members_longer_than_a_window(monkeypatch):
    end = warc.RECORD_END.encode()
    stored = [warc.gzip_member(warc.record_bytes(i, "u", random.Random(i).randbytes(50), None) + end) for i in range(9)]
    monkeypatch.setattr(warc, "WINDOW", 7)
    found = warc.walk(b"".join(stored) + b"rest")
    sizes = [len(m) for m in stored]
    assert [(a, n) for a, n, _ in found.records] == [(sum(sizes[:i]), sizes[i]) for i in range(9)]
    assert found.gaps == [(sum(sizes), sum(sizes) + 4, "no version line")]


def test_archives_are_salvaged_through_spark(spark, tmp_path):
    end = warc.RECORD_END.encode()
    stored = [warc.gzip_member(warc.record_bytes(i, f"u{i}", b"x%d" % i, None) + end) for i in range(40)]
    starts = [sum(map(len, stored[:i])) for i in range(41)]
    data = bytearray(b"".join(stored))
    for i in (3, 4, 20):
        data[starts[i] + len(stored[i]) // 2] ^= 0xFF
    (tmp_path / "a.warc.gz").write_bytes(data)
    (tmp_path / "b.warc.gz").write_bytes(stored[0])
    found = warc.read_warc(spark, str(tmp_path)).select(warc.page_id_of("record_id").alias("i"), "file", "offset").collect()
    assert sorted((r.i, r.offset) for r in found if "a.warc" in r.file) == [
        (i, starts[i]) for i in range(40) if i not in (3, 4, 20)
    ]
    assert [r.i for r in found if "b.warc" in r.file] == [0]
    gaps = warc.read_gaps(spark, str(tmp_path)).collect()
    assert sorted((r.start, r.stop) for r in gaps) == [(starts[3], starts[5]), (starts[20], starts[21])]
