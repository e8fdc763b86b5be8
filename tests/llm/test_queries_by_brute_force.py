"""Queries that SQL cannot express, against plain Python over the same tables."""

import hashlib
import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from ledgerleaf.llm.queries import QUERIES


@pytest.fixture(scope="module")
def documents(spark, sf_dir):
    return {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}


def _rows(spark, sf_dir, name):
    return {r.doc_id: r for r in QUERIES[name](spark, sf_dir).collect()}


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_bpe_equals_the_library(spark, sf_dir, documents):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    found = _rows(spark, sf_dir, "op1_bpe")
    assert set(found) == set(documents)
    for doc_id, text in documents.items():
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        row = found[doc_id]
        wanted = (len(ids), _sha(" ".join(map(str, ids))), _sha(decoded))
        assert (row.n_tokens, row.ids_sha256, row.decoded_sha256) == wanted


def test_decontamination_finds_whole_items_only(spark, sf_dir, documents):
    rows = spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()
    wanted = {
        (doc_id, row.item_id)
        for doc_id, text in documents.items()
        for row in rows
        if text and row.text in text
    }
    found = QUERIES["op3_decontamination"](spark, sf_dir).collect()
    assert {(r.doc_id, r.item_id) for r in found} == wanted
    assert all(r.edits == 0 for r in found)


PHRASES = (
    ("mit", "under the mit license".split()),
    ("apache-2", "apache license version 2".split()),
    ("cc-by-nc", "cc by nc".split()),
)


def test_license_phrases(spark, sf_dir, documents):
    found = _rows(spark, sf_dir, "op5_license")
    for doc_id, text in documents.items():
        lower = (text or "").translate({i: i + 32 for i in range(65, 91)})
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
        places = [
            (i, label)
            for label, phrase in PHRASES
            for i in range(len(words))
            if words[i : i + len(phrase)] == phrase
        ]
        row = found[doc_id]
        starts = [i for i, _ in places]
        labels = {label for _, label in places}
        assert (row.n_words, row.n_base) == (len(words), len(places))
        assert row.first_word == min(starts, default=None)
        assert row.last_word == max(starts, default=None)
        assert row.base_labels == ",".join(sorted(labels))
        assert labels <= set(row.labels.split(","))
        assert 0 <= row.score <= 1


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def base_spans(text):
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    for rank, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 16), (2, "hex", "[0-9a-f]+", 32)):
        found += [
            (m.start(), rank, kind, m.end())
            for m in re.finditer(pattern, text)
            if len(m[0]) >= least
        ]
    return [f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found)]


def test_base_secrets(spark, sf_dir, documents):
    found = _rows(spark, sf_dir, "op10_secrets")
    for doc_id, text in documents.items():
        wanted = base_spans(text or "")
        row = found[doc_id]
        kept = [s for s in row.spans.split(",") if s and not s.startswith("entropy")]
        assert kept == wanted
        assert row.base_sha256 == _sha(",".join(wanted))
        counts = [sum(s.startswith(k) for s in wanted) for k in ("assign", "access", "hex")]
        assert [row.n_assign, row.n_access, row.n_hex] == counts
