"""The pipeline against its stages done by brute force."""

import hashlib
import re

import corpus_pipeline
import public_tokenizers
from tokenizers import Tokenizer
from workcal.llm import op03_decontaminate, op04_secret_scan, op10_quality_rules

SF_DIR = "/root/testdata/sf0.001"


def test_rows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    bad = {r.doc_id for r in op10_quality_rules.ledger(docs).filter(op10_quality_rules.rejects(op10_quality_rules.STANDARD)).collect()}
    left = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in bad}
    sets = {}
    for k, t in left.items():
        w = re.findall(rb"[^\x20\x09-\x0D]+", t.encode().lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {k: k for k in left}
    links = [(a, b) for a in left for b in left if b < a and sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in left:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    left = {k: t for k, t in left.items() if label[k] == k}
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    kept = docs.filter(docs.doc_id.isin(list(left)))
    found = {r.doc_id for r in op03_decontaminate.contaminated(kept, items).collect()}
    left = {k: t for k, t in left.items() if k not in found}
    model = op04_secret_scan.train(docs.filter(docs.doc_id.isin(list(left))))
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    want = {}
    for k, t in left.items():
        known = op04_secret_scan.base_spans(t)
        clean = op04_secret_scan.mask(t, [*known, *op04_secret_scan.model_spans(t, model, known)])
        ids = tokenizer.encode(clean, add_special_tokens=False).ids
        want[k] = hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    got = {r.doc_id: r.ids_sha256 for r in corpus_pipeline.run(spark, SF_DIR).collect()}
    assert got == want


def test_stages_keep_columns(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for _, apply in corpus_pipeline.STAGES[:-1]:
        assert apply(spark, docs, SF_DIR).columns == docs.columns


def test_near_copies_with_edits(spark):
    """Against all pairs of the documents by brute force, at five-word shingles and 0.8, and edited copies planted on top."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    long = [t for _, t in rows if t and 150 <= len(t.split()) <= 400][:5]
    for k, t in enumerate(long):
        words = t.split()
        for at in (40, 80, 120):
            words[at] = "edited"
        rows.append((10**6 + k, " ".join(words)))
    sets = {}
    for k, t in rows:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[k] = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    label = {k: k for k in sets}
    links = [(a, b) for a in sets for b in sets if b < a and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    for _ in range(20):
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    assert sum(a >= 10**6 for a, _ in links) >= 3
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    kept = corpus_pipeline.near_copies(spark, frame, SF_DIR)
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k in label if label[k] == k)
