"""The stages of the corpus pipeline against plain Python, each on its own input."""

import hashlib
import re
from collections import Counter, defaultdict
from math import sqrt

import public_tokenizers
import pytest
from test_corpus_operators import gone_lines, groups_of
from tokenizers import Tokenizer

import corpus_pipeline
from ledgerleaf.scratch import settle

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf_dir):
    """Rows before the first stage and after each one."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = [rows.collect()]
    for name, stage in corpus_pipeline.STAGES:
        rows = settle(stage(spark, rows, sf_dir), name)
        assert name == "bpe" or rows.columns == COLUMNS
        found.append(rows.collect())
    return found


def failures(text):
    """(base rule fails, any rule fails) of a text."""
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = set()
    for i in range(len(words) - 2):
        if grams[tuple(words[i : i + 3])] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars = len(words), sum(map(len, words))
    base = n < 50 or 100 * len(covered) > 50 * n
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    repeated = len(lines) - len(set(lines))
    soft = 100 * symbols > 10 * n or 100 * repeated > 30 * len(lines)
    return base, base or soft or chars < 2 * n or chars > 15 * n


def kept_by_rules(rows):
    hosts = defaultdict(lambda: [0, 0])
    failed = {}
    for r in rows:
        failed[r.doc_id] = failures(r.text)
        hosts[r.source][0] += 1
        hosts[r.source][1] += failed[r.doc_id][1]
    n = sum(a for a, _ in hosts.values())
    mean = sum(b for _, b in hosts.values()) / n
    chance = mean * (1 - mean)
    between = sum(b * b / a for a, b in hosts.values()) - n * mean**2 - (len(hosts) - 1) * chance
    variance = between / max(n - (len(hosts) - 1), 1)
    strength = min(max(chance / variance - 1, 1), 10000) if variance > 0 else 10000
    kept = set()
    for r in rows:
        a, b = hosts[r.source]
        rate = (b + mean * strength) / (a + strength)
        spread = 2 * sqrt(rate * (1 - rate) / (a + strength + 1))
        base, soft = failed[r.doc_id]
        strict = rate + spread > 0.01
        if not (base or rate - spread > 0.5 or (strict and soft)):
            kept.add(r.doc_id)
    return kept


def test_quality_stage(stages):
    assert {r.doc_id for r in stages[1]} == kept_by_rules(stages[0])
    assert {r.doc_id: r.text for r in stages[1]}.items() <= {r.doc_id: r.text for r in stages[0]}.items()


def test_line_stage(stages):
    gone = gone_lines([(r.doc_id, r.text) for r in stages[1]])
    wanted = {
        r.doc_id: "\n".join(x for k, x in enumerate(r.text.split("\n")) if (r.doc_id, k) not in gone)
        for r in stages[1]
    }
    assert {r.doc_id: r.text for r in stages[2]} == wanted
    assert all(r.n_chars == len(r.text) for r in stages[2])


def test_near_duplicate_stage(stages):
    groups = groups_of([(r.doc_id, r.text) for r in stages[2]], 80)
    assert {r.doc_id for r in stages[3]} == {i for i, group in groups.items() if i == group}


def test_decontamination_stage(spark, sf_dir, stages):
    items = [r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in stages[3] if not any(item in r.text for item in items)}
    assert {r.doc_id for r in stages[4]} == clean


def test_token_stage(stages):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    texts = {r.doc_id: r.text for r in stages[4]}
    assert {r.doc_id for r in stages[5]} == set(texts)
    for r in stages[5]:
        ids = tokenizer.encode(texts[r.doc_id], add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        assert (r.ids, r.n_tokens) == (ids, len(ids))
        assert r.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()


def test_stages_on_odd_rows(spark, sf_dir):
    """Nulls, empty texts, repeated rows, extra columns, and no rows at all."""
    text = " ".join(f"word{i}" for i in range(60))
    rows = [
        (1, text, "en", "a", len(text), "x"),
        (1, text, "en", "a", len(text), "x"),
        (None, text + " more", None, None, None, None),
        (2, None, "en", None, None, "y"),
        (3, "", None, "a", 0, "z"),
    ]
    schema = "doc_id long, text string, lang string, source string, n_chars long, n string"
    docs = spark.createDataFrame(rows, schema)
    for start in (docs, docs.limit(0)):
        current = start
        for name, stage in corpus_pipeline.STAGES:
            result = settle(stage(spark, current, sf_dir), name)
            alone = stage(spark, start, sf_dir)
            assert name == "bpe" or alone.columns == start.columns
            assert alone.count() <= start.count()
            current = result
    assert [r.doc_id for r in current.collect()] == []


def test_run_is_all_stages(spark, sf_dir, stages):
    found = {r.doc_id: r.n_tokens for r in corpus_pipeline.run(spark, sf_dir).collect()}
    assert found == {r.doc_id: r.n_tokens for r in stages[-1]}
