"""Prefix trie, token files and Merkle manifest against brute-force versions."""

import glob
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow.orc as orc
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from workcal.llm import op11_prefix_trie, op12_token_orc, op13_merkle
from workcal.llm.ordering import numbered
from workcal.llm.queries import QUERIES
from workcal.scratch import scratch_dir

SF_DIR = "/root/testdata/sf0.001"
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def written(spark, df, name):
    """``df`` as the table ``name`` of a folder of its own."""
    folder = scratch_dir(spark, "tables")
    df.write.parquet(f"{folder}/{name}.parquet")
    return folder


# --- order -------------------------------------------------------------------


def test_ranks(spark):
    r = random.Random(3)
    rows = [(r.choice([None, "a", "a", "a", "b", "ß"]), r.choice([None, 1, 2, 3]), k) for k in range(3000)]
    rows += [("z", 5, -1)]
    df = spark.createDataFrame(rows, "g string, v bigint, k bigint")
    got = {x.k: x._rank for x in numbered(df, ["g"], ["v", "k"], "t").collect()}
    alone = {x.k: x._rank for x in numbered(df, [], ["g", "v", "k"], "t").collect()}
    first = lambda v: (v is not None, (v.encode() if isinstance(v, str) else v) if v is not None else 0)
    ordered = sorted(rows, key=lambda x: (first(x[0]), first(x[1]), x[2]))
    seen = {}
    for at, (g, _, k) in enumerate(ordered):
        assert (got[k], alone[k]) == (seen.get(g, 0), at)
        seen[g] = seen.get(g, 0) + 1
    assert numbered(df.limit(0), ["g"], ["v"], "t").count() == 0


# --- prefix trie -------------------------------------------------------------


def trie(rows):
    """The contract of the trie restated: rebuild, then one dictionary of prefixes."""
    own = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            own.setdefault(conv_id, []).append(((turn is not None, turn or 0), (role or "", text or "")))
    own = {c: [t for _, t in sorted(ts, key=lambda x: x[0])] for c, ts in own.items()}
    built = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        built[c] = own.get(c - int(np.fmod(c, 100)), [])[:h] + ts[h:]
    nodes = {}
    for c, ts in built.items():
        for d in range(len(ts) + 1):
            nodes.setdefault(tuple(ts[:d]), []).append(c)
    out = []
    for node, members in nodes.items():
        below = [n for n in nodes if n[: len(node)] == node]
        children = [n for n in below if len(n) == len(node) + 1]
        leaves = [n for n in below if not any(m[: len(n)] == n and len(m) > len(n) for m in below)]
        saved = sum((len(nodes[n]) - 1) * len(n[-1][1]) for n in below if n)
        ends = ",".join(map(str, sorted(c for c in members if len(built[c]) == len(node))))
        parent = min(nodes[node[:-1]]) if node else None
        out.append((min(members), len(node), parent, len(members), len(children), len(leaves), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


TURNS = "conv_id bigint, turn bigint, role string, text string, n bigint, depth string"


@pytest.fixture(scope="module")
def conversations(spark):
    r = random.Random(11)
    rows = []
    for c in [*range(40), *range(100, 130), *range(-130, -90), 300, 301, 305, 9999, 2**40 + 7]:
        length = r.choice([1, 1, 2, 3, 5, 8])
        rows += [(c, k, r.choice(["user", "bot"]), r.choice(["hi", "no", "é漢", "", "long " * 20])) for k in range(length)]
    rows += [(20_001, k, "user", f"t{k % 3}") for k in range(60)] + [(20_002, k, "user", f"t{k % 3}") for k in range(60)]
    rows += [(20_003, k, "user", f"t{k % 3}") for k in range(41)] + [(20_004, 0, None, None), (20_005, None, None, "x")]
    rows += [(20_005, 3, "user", None), (20_006, 1, "user", "twice"), (20_006, 1, "user", "twice"), (None, 0, "user", "lost")]
    return [(*row, 1, "d") for row in rows], spark.createDataFrame([(*row, 1, "d") for row in rows], TURNS)


def test_trie_query(spark, conversations):
    rows, df = conversations
    got = QUERIES["op11_prefix_trie"](spark, written(spark, df, "conversations"))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == trie([row[:4] for row in rows])


@pytest.mark.parametrize(("size", "shard"), [(8, 3), (6, 1), (1024, 7)])
def test_trie_in_blocks_and_shards(spark, conversations, size, shard):
    """Conversations of several blocks, and shards that share most nodes, in any order of rows."""
    rows, df = conversations
    m = op11_prefix_trie
    head = F.crc32(F.col("conv_id").cast("string")) % 6
    cut = m.blocks(m.numbered_turns(df), head, size).repartition(3, F.rand(5))
    nodes, ends = m.prefix_trie(cut, shard)
    digests = {(r.node1, r.node2): r.ends_sha256 for r in m.end_digests(ends).collect()}
    nothing = hashlib.sha256(b"").hexdigest()
    got = [
        (r.conv_id, r.depth, r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens,
         digests.get((r.node1, r.node2), nothing))
        for r in nodes.collect()
    ]
    assert sorted(got, key=str) == trie([row[:4] for row in rows])


def test_trie_of_nothing(spark, conversations):
    _, df = conversations
    for none in (df.limit(0), df.filter("conv_id IS NULL")):
        assert QUERIES["op11_prefix_trie"](spark, written(spark, none, "conversations")).count() == 0


def test_one_conversation_many_copies(spark):
    """A group of copies is one path, whatever its size; its end list is in order."""
    copies = 70_000
    rows = spark.range(copies).selectExpr("id * 3 AS conv_id", "explode(sequence(0L, 1L)) AS turn", "'user' AS role", "concat('x', turn) AS text")
    m = op11_prefix_trie
    nodes, ends = m.prefix_trie(m.blocks(m.numbered_turns(rows)))
    assert sorted((r.depth, r.n_convs, r.n_leaves, r.saved_tokens) for r in nodes.collect()) == [
        (0, copies, 1, 4 * (copies - 1)), (1, copies, 1, 4 * (copies - 1)), (2, copies, 1, 2 * (copies - 1)),
    ]
    want = hashlib.sha256(",".join(str(3 * k) for k in range(copies)).encode()).hexdigest()
    assert [r.ends_sha256 for r in m.end_digests(ends).collect()] == [want]


# --- token files -------------------------------------------------------------


TEXTS = [
    None, "", " ", "one", "One two", "two\n\n\n  three \t four", "x" * 60_000, " " * 9_000 + "a", "a" + "\n" * 5_000, "漢字" * 9_000,
    "<|endoftext|> ends <|endoftext|>", "'s 've 'LL don't", "\x00\x1c\x85 　é", "word, " * 40_000, "123456 7.8e9",
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = [(k * 7 % 15, t, "kept", 3) for k, t in enumerate(TEXTS)]
    rows += [rows[3], rows[3], (None, "nameless", None, None), (4, "another text", None, None)]
    return rows, spark.createDataFrame(rows, "doc_id bigint, text string, part string, ids bigint")


def library():
    t = Tokenizer.from_file(BYTE_BPE)
    t.no_truncation()
    t.no_padding()
    return lambda text: [*t.encode(text or "", add_special_tokens=False).ids, 2]


def tokens(rows):
    encode, at, out = library(), 0, []
    for doc_id, text, *_ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, len(r[1] or ""))):
        ids = encode(text)
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_token_query(spark, texts):
    rows, df = texts
    got = QUERIES["op12_token_orc"](spark, written(spark, df, "documents"))
    assert got.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[1]) == tokens(rows)


def test_token_query_on_given_documents(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    assert sorted(map(tuple, QUERIES["op12_token_orc"](spark, SF_DIR).collect()), key=lambda r: r[1]) == tokens(rows)


def test_token_query_of_nothing(spark, texts):
    assert QUERIES["op12_token_orc"](spark, written(spark, texts[1].limit(0), "documents")).count() == 0


def test_ids_of_another_tokenizer(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    t = Tokenizer.from_file(path)
    t.no_truncation()
    t.no_padding()
    assert op12_token_orc.encoder(path)("Some Words here").tolist() == t.encode("Some Words here", add_special_tokens=False).ids


def test_stripes_statistics_and_bloom_filters(spark, plan):
    """Even ids only: an odd one lies within every range, and only a Bloom filter rules it out."""
    r = random.Random(4)
    rows = [(2 * k, " ".join(f"w{r.randrange(9999)}" for _ in range(40))) for k in range(12_000)]
    folder = scratch_dir(spark, "tokens")
    op12_token_orc.write_tokens(spark.createDataFrame(rows, "doc_id bigint, text string"), BYTE_BPE, folder)
    files = sorted(glob.glob(re.sub("^file:/*", "/", folder) + "/*.orc"))
    kept = [orc.ORCFile(f).read(["doc_id"]).column(0).to_pylist() for f in files]
    assert len(files) > 1 and sum(kept, []) == [i for i, _ in rows]
    assert all(orc.ORCFile(f).nstripes >= 1 and orc.ORCFile(f).row_index_stride == op12_token_orc.INDEX_ROWS for f in files)
    assert all(b"doc_id" in open(f, "rb").read() and orc.ORCFile(f).nrows == len(k) for f, k in zip(files, kept))

    def scanned(doc_ids):
        found = op12_token_orc.lookup(spark, folder, doc_ids)
        assert "PushedFilters: [In(doc_id" in plan(found) or "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id" in plan(found)
        listed = found.collect()
        node = found._jdf.queryExecution().executedPlan()
        while node.children().size():
            node = node.children().apply(0)
        return listed, node.metrics().apply("numOutputRows").value()

    want = library()(rows[70][1])
    found, read = scanned([140])
    assert [x.ids for x in found] == [want] and read <= op12_token_orc.INDEX_ROWS
    found, read = scanned([141])
    assert found == [] and read < op12_token_orc.INDEX_ROWS


# --- manifest ----------------------------------------------------------------


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(*fields):
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields))


def levels(digests):
    found = [digests]
    while len(found[-1]) > 1:
        run = found[-1]
        found.append([H("".join(run[k : k + 8])) for k in range(0, len(run), 8)])
    return found


def path(tree, at):
    for level in tree[:-1]:
        begin = at // 8 * 8
        run = level[begin : begin + 8]
        yield "".join(run[: at - begin]), "".join(run[at - begin + 1 :])
        at //= 8


def manifest(rows):
    first = lambda v: (v is not None, v if v is not None else 0)
    langs = {}
    for r in rows:
        langs.setdefault(r[2], []).append((first(r[0]), leaf(*r), r))
    order = sorted(langs, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in order:
        langs[lang].sort(key=lambda x: x[:2])
        trees[lang] = levels([d for _, d, _ in langs[lang]])
    upper = levels([trees[lang][-1][0] for lang in order])
    out = []
    for k, lang in enumerate(order):
        for at, (_, own, r) in enumerate(langs[lang]):
            siblings = [*path(trees[lang], at), *path(upper, k)]
            folded = own
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0:
                low = r[4] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4])
                folded = leaf(*r[:4], low)
            for left, right in siblings:
                folded = H(left + folded + right)
            out.append((r[0], own, trees[lang][-1][0], upper[-1][0], H("".join(a + b for a, b in siblings)), folded, folded == upper[-1][0]))
    return sorted(out, key=str)


DOCUMENT = "doc_id bigint, source string, lang string, n_chars bigint, text string, part string, leaf bigint"


@pytest.mark.parametrize("sizes", [{"en": 600, "de": 64, None: 9, "漢": 1, "": 2}, {f"l{k}": 1 for k in range(70)}, {"en": 1}])
def test_manifest_query(spark, sizes):
    r = random.Random(6)
    rows = [
        (r.choice([None, k]) if k % 50 == 0 else k, r.choice([None, "ß", "web"]), lang, r.choice([None, 5]), r.choice([None, "", "Plain É Text", "low"]))
        for lang, n in sizes.items() for k in range(n)
    ]
    rows += [rows[0], rows[0], (rows[0][0], "other", *rows[0][2:])]
    df = spark.createDataFrame([(*row, "x", 1) for row in rows], DOCUMENT)
    got = QUERIES["op13_merkle"](spark, written(spark, df, "documents"))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == manifest(rows)


def test_manifest_of_nothing(spark):
    none = spark.createDataFrame([], DOCUMENT)
    assert QUERIES["op13_merkle"](spark, written(spark, none, "documents")).count() == 0


def test_proofs_of_some_leaves(spark):
    """Requests for a few leaves give the same paths as those for all."""
    rows = spark.range(700).selectExpr("if(id < 600, 'a', 'b') AS part", "id AS key", "sha2(string(id), 256) AS leaf")
    built = op13_merkle.build(rows)
    every = {x.key: (x.leaf, x.path, x.root) for x in op13_merkle.proofs(built).collect()}
    asked = built.leaves.filter("key IN (0, 7, 8, 599, 600, 699)")
    some = op13_merkle.proofs(built, asked)
    assert {x.key: (x.leaf, x.path, x.root) for x in some.collect()} == {k: every[k] for k in (0, 7, 8, 599, 600, 699)}
    folded = some.select(op13_merkle.fold(F.col("leaf"), F.col("path")).alias("f"), "root").collect()
    assert all(x.f == x.root == op13_merkle.root_of(built) for x in folded)


def test_equal_runs_are_one_record(spark):
    rows = spark.range(64).selectExpr("'a' AS part", "0L AS key", "sha2('same', 256) AS leaf")
    built = op13_merkle.build(rows)
    assert [x.distinct().count() for x in built.lower.records] == [1, 1]
    assert op13_merkle.proofs(built).filter(op13_merkle.fold(F.col("leaf"), F.col("path")) == F.col("root")).count() == 64
