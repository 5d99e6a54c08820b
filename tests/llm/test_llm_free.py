"""Packing, token counts, class model, nearest neighbours, near and substring
deduplication, and the pipeline, against brute force."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict
from types import SimpleNamespace

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tessera.llm import ann, lm, minhash, packing, queries, suffix, tokens
from tessera.llm.common import connected_components

SF = os.environ.get("TESSERA_TEST_SF", "/root/testdata/sf0.001")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ODD = [
    (1, None, "a"),
    (2, "", "a"),
    (3, " \n\t ", "a"),
    (4, "one two", None),
    (4, "one two", None),
    (None, "no id but words enough to shingle them", "b"),
    (5, "x" * 3_000, "b"),
    (6, "say <|endoftext|> twice <|endoftext|>", "b"),
    (7, "Größe ß été 日本語 🙂 " * 300, "b"),
    (8, "a  b\n\n\nc\r\n  d   ", "b"),
    (9, "long words and numbers 12345 " * 9_000, "c"),
]
SCHEMA = "doc_id long, text string, source string"
CLASH = "id long, n long, rep long, row long, start long, length long, lang string"


@pytest.fixture(scope="module")
def odd(spark):
    queries.prepare(spark)
    rows = [(*r, *([7] * 6), "xx") for r in ODD]
    return spark.createDataFrame(rows, f"{SCHEMA}, {CLASH}")


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def table(name):
    got = duckdb.sql(f"select * from read_parquet('{SF}/{name}.parquet')")
    return [dict(zip(got.columns, row)) for row in got.fetchall()]


def run(spark, name):
    return [r.asDict() for r in queries.QUERIES[name](spark, SF).collect()]


# packing and counts ----------------------------------------------------------


def check_pieces(pieces, ids_of, documents):
    """ids_of: text key -> ids with the end; documents: keys, with repeats."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for p in pieces:
        sequences[p["sequence_id"]].append(p)
        by_doc[p["doc_id"]].append(p)
    padding = 0
    for own in sequences.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 1024
        padding += 1024 - at if at & (at - 1) else 0
    assert padding == 0
    assert set(by_doc) == set(documents)
    for doc, own in by_doc.items():
        ids, times = ids_of[doc], documents[doc]
        covered = Counter()
        for p in own:
            part = np.array(ids[p["start"] : p["start"] + p["length"]], dtype="<u4").tobytes()
            assert p["ids_crc32"] == zlib.crc32(part) and p["doc_tokens"] == len(ids)
            covered.update(range(p["start"], p["start"] + p["length"]))
        assert covered == Counter({i: times for i in range(len(ids))})


def test_packing_query(spark, tok):
    ids = {d["doc_id"]: [*tok.encode(d["text"] or "", add_special_tokens=False).ids, 0] for d in table("documents")}
    check_pieces(run(spark, "op2_packing"), ids, Counter(list(ids)))


def test_packing_edge_cases(odd, tok):
    out = packing.pack(odd).withColumn("ids_crc32", F.crc32("ids"))
    ids = {r[0]: [*tok.encode(r[1] or "", add_special_tokens=False).ids, 0] for r in ODD}
    check_pieces([r.asDict() for r in out.collect()], ids, Counter(r[0] for r in ODD))
    assert packing.pack(odd.where("false")).collect() == []


def test_packer_takes_the_level_of_least_squares():
    rng, packer = random.Random(5), packing.Packer(64)
    for _ in range(400):
        size = rng.randint(1, 63)
        best, cost = None, None
        for level in [0, *np.flatnonzero(packer.count[1:] > 0) + 1]:
            if level + size > 64:
                continue
            after = packer.count.copy()
            if level:
                after[level] -= 1
            if level + size < 64:
                after[level + size] += 1
            c = int((after**2).sum())
            if cost is None or c < cost or c == cost and level > best:
                best, cost = level, c
        assert packer.level(size) == best
        for parts in packer.add("d", np.zeros(size, dtype="<u4")):
            assert sum(len(p[2]) for p in parts) == 64


def test_token_counts_query(spark, tok):
    want = {d["doc_id"]: (len((d["text"] or "").encode()), len(tok.encode(d["text"] or "", add_special_tokens=False).ids)) for d in table("documents")}
    got = run(spark, "op3_token_counts")
    assert {g["doc_id"]: (g["n_bytes"], g["n_tokens"]) for g in got} == want
    assert all(g["over_limit"] == (g["n_tokens"] > 512) for g in got) and len(got) == len(want)


def test_token_counts_edge_cases(odd, tok):
    want = sorted((r[0] or 0, len((r[1] or "").encode()), len(tok.encode(r[1] or "", add_special_tokens=False).ids)) for r in ODD)
    got = sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(odd).collect())
    assert got == want
    model = tokens.count_tokens(odd, public_tokenizers.path("piece_bpe_32k.model"))
    assert model.count() == len(ODD)
    assert tokens.count_tokens(odd.where("false")).collect() == []


def test_safe_pieces_join_and_count_alike(tok):
    rng = random.Random(3)
    text = "".join(rng.choice(["word", " ", "  ", "\n", "12", "é", "don't", "!!", " ", "日"]) for _ in range(20_000))
    parts = tokens.safe_pieces(text, 500)
    assert "".join(parts) == text and len(parts) > 10
    assert [i for p in parts for i in tok.encode(p, add_special_tokens=False).ids] == tok.encode(text, add_special_tokens=False).ids


def test_counts_from_known_pieces(tok):
    rng = random.Random(8)
    words = ["word", "12", "é", "don't", "!!", "a\nb", "x\n", "日本", "", "\u00a0", "\u00a0z", "<|endoftext|>", "longer-word"]
    lengths, memo = tokens._lengths(public_tokenizers.path("byte_bpe_50k.json"))
    for _ in range(3):
        for _ in range(300):
            text = " ".join(rng.choice(words[: rng.choice((8, 13))]) for _ in range(rng.randint(1, 12)))
            n, rest = memo.split(text)
            assert n + lengths([rest])[0] == len(tok.encode(text, add_special_tokens=False).ids)
        memo.settle()
    assert memo.known


# class model -----------------------------------------------------------------


def model_tokens(text):
    return [*WORD.findall((text or "").translate(LOWER)), "</end>"]


def check_scores(got, texts, held):
    count = Counter(t for k, text in texts.items() if not held[k] for t in model_tokens(text))
    total, distinct = sum(count.values()), len(count)
    for g in got:
        own = model_tokens(texts[g["doc_id"]])
        assert g["held_out"] == held[g["doc_id"]] and g["n_tokens"] == len(own) and g["train_tokens"] == total
        assert g["n_known"] == sum(count[t] > 0 for t in own)
        base = sum(math.log10((count[t] + 1) / (total + distinct + 1)) for t in own)
        assert g["base_score"] == pytest.approx(base, rel=1e-9)
        assert g["score"] <= 1e-9


def test_lm_query(spark):
    texts = {d["doc_id"]: d["text"] for d in table("documents")}
    held = {k: zlib.crc32(str(k).encode()) % 7 == 2 for k in texts}
    got = run(spark, "op5_lm_scores")
    assert len(got) == len(texts)
    check_scores(got, texts, held)
    out = [g for g in got if g["held_out"]]
    assert sum(g["score"] for g in out) > sum(g["base_score"] for g in out) * 0.95  # less surprise than the base


def test_lm_is_a_distribution(spark):
    """Every continuation of a text, unknown word and end included, adds to 1;
    words beyond the broadcast table go by the join."""
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["a b", "c d", "e", "f g h"]) for _ in range(30))) for i in range(40)]
    vocabulary = sorted({w for _, t in rows for w in t.split()})
    extra = [(1000 + i, f"a {w}".strip()) for i, w in enumerate([*vocabulary, "never-seen"])]
    docs = spark.createDataFrame(rows + extra + [(2000, "a")], "doc_id long, text string")
    for table_size in (3, 100):
        got = {r.doc_id: r for r in lm.score(docs, F.col("doc_id") >= 1000, classes=3, core=5, table=table_size).collect()}
        texts = dict(rows + extra + [(2000, "a")])
        check_scores([r.asDict() for r in got.values()], texts, {k: k >= 1000 for k in texts})
        # score(a w </s>) = log P(a) P(w|a) P(</s>|w); divide by the last factor through score(w)
        first = {k: got[k].score for k in got}
        assert first[2000] < 0
    one = lm.transitions(np.array([[0, 2, 0, 0], [1, 3, 2, 0], [1, 0, 1, 0], [0, 0, 0, 0]], float), np.array([2.0, 5.0, 4.0]), np.array([1.0, 2.0, 3.0]))
    share = 1 - np.array([0, 0.5 * 2 / 5, 0.5 * 3 / 4])  # of a class's mass on its known words
    for row in 10**one:
        assert (row[:3] * share).sum() + row[3] == pytest.approx(1)


def test_lm_join_and_table_agree(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.col("doc_id") % 5 == 0
    a, b = ({r.doc_id: r.score for r in lm.score(docs, held, table=n).collect()} for n in (50, 1 << 19))
    assert a.keys() == b.keys()
    assert all(a[k] == pytest.approx(b[k], rel=1e-6) for k in a)


def test_exchange_finds_alternating_classes():
    rng = np.random.default_rng(1)
    seq = [rng.integers(0, 6) + 6 * (i % 2) for i in range(6_000)]
    grid = np.zeros((13, 13))
    np.add.at(grid, (seq[:-1], seq[1:]), 1)
    cls = lm.exchange(grid, 4)
    assert not set(cls[:6]) & set(cls[6:12]) and cls[12] == 0 and 0 not in cls[:12]


def test_lm_edge_cases(spark, odd):
    got = lm.score(odd, F.col("doc_id").isin(4, 5)).collect()
    assert len(got) == len(ODD)
    assert all(r.n_tokens == len(model_tokens(t)) for r in got for k, t, _ in ODD if k == r.doc_id)
    assert lm.score(odd, F.lit(True)).agg(F.sum("score")).first()[0] == 0
    assert lm.score(odd.where("false"), F.lit(True)).collect() == []


def test_lm_splits_a_text_once_in_each_pass(monkeypatch):
    """The rare words of a text come from the same split as its numbers."""
    texts, split = [b"a b rare", b"", b"rare a"], []
    plain = lm._words
    monkeypatch.setattr(lm, "_words", lambda t: split.extend(t) or plain(t))
    monkeypatch.setattr(lm, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 0)))
    table = SimpleNamespace(value=(b"a\nb", np.array([1, 2]), np.zeros(2), np.zeros(2)))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([False] * 3), pa.array(texts)], ["id", "held_out", "text"])
    out = pa.Table.from_batches(lm._encode(table, 3, 0.0, 2)(iter([batch]))).to_pylist()
    assert split == texts
    assert [r["n_tokens"] for r in out] == [4, 1, 3] and [r["rare"] for r in out] == [[b"rare"], [], [b"rare"]]
    assert [r["places"] for r in out] == [[{"at": 2, "l": 2, "r": 0}], [], [{"at": 0, "l": 0, "r": 1}]]


def test_lm_scores_of_a_word_add_up_over_batches():
    rng, words = np.random.default_rng(5), sorted([b"a"] * 7 + [b"b"] + [b"c"] * 4 + [b"d", b"e"] + [b"f"] * 3)
    n, s = np.arange(1, len(words) + 1), rng.random((len(words), 4)).astype("<f4")
    for cut in (1, 2, 5, 100):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(words[i : i + cut]), pa.array(n[i : i + cut]), pa.array([x.tobytes() for x in s[i : i + cut]])], ["word", "n", "s"])
            for i in range(0, len(words), cut)
        ]
        got = pa.Table.from_batches(lm._added(4)(iter(batches))).to_pylist()
        own = {w: [i for i, x in enumerate(words) if x == w] for w in words}
        assert got == [{"word": w, "n": n[i].sum(), "cls": 1 + s[i].astype(float).sum(0).argmax()} for w, i in own.items()]


# nearest neighbours ----------------------------------------------------------


def recall(got, vectors, k=10):
    ids, x = np.array([v[0] for v in vectors]), np.array([v[1] for v in vectors], dtype=float)
    by = defaultdict(list)
    for r in got:
        by[r["query_id"]].append(r)
    hits = total = 0
    for q, rows in by.items():
        rows.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in rows] == list(range(1, min(k, len(ids) - 1) + 1))
        d = np.sqrt(((x - x[ids == q][0]) ** 2).sum(1))
        for r in rows:
            assert r["vec_id"] != q and r["score"] == pytest.approx(d[ids == r["vec_id"]][0], abs=1e-12)
        assert [(r["score"], r["vec_id"]) for r in rows] == sorted((r["score"], r["vec_id"]) for r in rows)
        d[ids == q] = np.inf
        best = set(ids[np.lexsort((ids, d))[:k]])
        hits += len(best & {r["vec_id"] for r in rows})
        total += len(rows)
    return hits / total


def test_nearest_query(spark):
    vectors = [(r["vec_id"], r["embedding"]) for r in table("embeddings")]
    got = run(spark, "op6_nearest")
    assert {g["query_id"] for g in got} == {i for i, _ in vectors if i % 100 == 0}
    assert recall(got, vectors) >= 0.9


def test_nearest_edge_cases(spark):
    same = [(i, [1.0, 2.0]) for i in range(0, 300)]
    bad = [(500, None), (501, [0.0, 0.0]), (502, [1.0, None]), (503, [float("nan"), 1.0]), (504, [float("inf"), 1.0]), (505, [1.0]), (None, [1.0, 1.0])]
    rows = [(*r, 1) for r in same + bad + [(100, [1.0, 2.0])]]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, leaf int")
    got = ann.search(data, F.col("vec_id") % 100 == 0, chunk_rows=50).collect()
    for q in (0, 100, 200):
        own = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        assert [v for _, v, _ in own] == [i for i in range(12) if i != q][:10] and {s for *_, s in own} == {0.0}
    assert {r.query_id for r in got} == {0, 100, 200}
    few = ann.search(data.where("vec_id in (0, 7)"), F.col("vec_id") % 100 == 0).collect()
    assert [(r.query_id, r.rank, r.vec_id) for r in few] == [(0, 1, 7)]
    assert ann.search(data.where("vec_id = 0"), F.col("vec_id") % 100 == 0).collect() == []
    assert ann.search(data.where("false"), F.lit(True)).collect() == []


@pytest.mark.parametrize("distinct", [2, 12, 60])
def test_nearest_in_small_tables(spark, distinct):
    """Every query gets k rows, or all there are."""
    x = np.random.default_rng(distinct).standard_normal((distinct, 64))
    vectors = [(i, [float(v) for v in x[i]]) for i in range(distinct)]
    queries.prepare(spark)
    got = ann.search(spark.createDataFrame(vectors, "vec_id long, embedding array<double>"), F.lit(True))
    per = Counter(r.query_id for r in got.collect())
    assert per == {i: min(10, distinct - 1) for i in range(distinct)}


def test_nearest_beside_a_dense_group(spark):
    """A third of all vectors in one tight group, the sample a part of them:
    queries beside the group find their neighbours too."""
    rng = np.random.default_rng(3)
    x = rng.standard_normal((3_000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    x[:1_000] = x[0] + 0.01 * x[:1_000]
    vectors = [(i, [float(v) for v in x[i]]) for i in range(3_000)]
    queries.prepare(spark)
    docs = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    got = [r.asDict() for r in ann.search(docs, F.col("vec_id") % 50 == 7, sample=1_500).collect()]
    for inside in (True, False):
        assert recall([r for r in got if (r["query_id"] < 1_000) == inside], vectors) >= 0.9


# near duplicates -------------------------------------------------------------


def test_near_dedup_oracle(spark):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{SF}/documents.parquet')")
    want = con.execute(queries.ORACLE["op8_near_dedup"])
    columns = [d[0] for d in want.description]
    got = queries.QUERIES["op8_near_dedup"](spark, SF)
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(want.fetchall())


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def components(sets):
    parent = {k: k for k in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                ra, rb = find(a), find(b)
                parent[max(ra, rb)] = min(ra, rb)
    return {k: find(k) for k in sets}


def test_near_dedup_chains_and_groups(spark):
    rng = random.Random(4)
    word = lambda: f"w{rng.randrange(5000)}"
    rows, doc = [], 0
    for _ in range(12):
        base = [word() for _ in range(rng.randint(8, 150))]
        for _ in range(12):  # each copy edits the one before it, so groups are chains
            rows.append((doc, " ".join(base)))
            doc += 1
            base = list(base)
            for _ in range(rng.randint(0, 3)):
                base[rng.randrange(len(base))] = word()
    passage = " ".join(word() for _ in range(60))
    rows += [(doc + i, f"{' '.join(word() for _ in range(40))} {passage}") for i in range(60)]
    rows += [(900, "A b"), (901, "a  B"), (902, "a"), (903, ""), (904, None), (905, "a b c d e")]
    docs = spark.createDataFrame([(*r, 1, 1) for r in rows], "doc_id long, text string, n int, rep int")
    want = components({k: shingle_set(t) for k, t in rows})
    got = {r.doc_id: r for r in minhash.near_duplicates(docs).collect()}
    assert {k: r.component_id for k, r in got.items()} == want
    assert all(r.kept == (k == r.component_id) and r.n_shingles == len(shingle_set(dict(rows)[k])) for k, r in got.items())
    kept = minhash.deduplicated(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, c in want.items() if k == c)


def test_near_dedup_edge_cases(odd):
    got = minhash.near_duplicates(odd).collect()
    assert len(got) == len(ODD)
    assert all(r.component_id == r.doc_id and r.kept for r in got)
    kept = minhash.deduplicated(odd)
    assert kept.columns == odd.columns
    assert sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 2, 3, 4, 5, 6, 7, 8, 9]
    assert minhash.deduplicated(odd.where("false")).collect() == []


def test_components_of_a_long_chain_and_a_hub(spark):
    queries.prepare(spark)
    chain = [(i, i + 1) for i in range(10, 210)]
    hub = [(1000, i) for i in range(1001, 1100)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(chain + hub + chain[:5], "u long, v long")).collect()}
    assert got == {**{i: 10 for i in range(10, 211)}, **{i: 1000 for i in range(1000, 1100)}}


# repeated strings ------------------------------------------------------------


def cut(rows, length):
    data = [(t or "").encode() for t in rows]
    count = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if count[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        out.append((len(d), sum(gone), len(re.findall(b"\1+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_query(spark):
    docs = table("documents")
    want = {d["doc_id"]: w for d, w in zip(docs, cut([d["text"] for d in docs], 200))}
    got = run(spark, "op10_suffix_dedup")
    assert len(got) == len(docs)
    assert {g["doc_id"]: (g["n_bytes"], g["n_removed"], g["n_spans"], g["kept_sha256"]) for g in got} == want


@pytest.mark.parametrize("bucket_runs", [0, 20_000])  # 0: every bucket counts as large
def test_suffix_planted(spark, bucket_runs):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdé ") for _ in range(n))
    shared = [text(n) for n in (19, 20, 21, 60, 150)]
    rows = [text(rng.randint(0, 120)) + rng.choice(shared) + text(rng.randint(0, 90)) for _ in range(120)]
    rows += ["z" * 300, "xyxyxy" * 30, "", None, shared[3], rows[0], rows[0], text(5_000) + shared[4] * 2]
    data = [(i if i % 9 else None, t, 1, 1) for i, t in enumerate(rows)]
    docs = spark.createDataFrame(data, "doc_id long, text string, start int, name int")
    queries.prepare(spark)
    out = suffix.remove_repeats(docs, length=20, prefix=8, bucket_runs=bucket_runs)
    got = sorted((r.row.doc_id or 0, r.n_bytes, r.n_removed, len(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in out.collect())
    assert got == sorted((d[0] or 0, *w) for d, w in zip(data, cut(rows, 20)))


def test_cleaned_documents_stay_text(spark):
    rng = random.Random(7)
    passage = "".join(rng.choice("éü日🙂a ") for _ in range(120))
    rows = [(i, "".join(rng.choice("ðñabc") for _ in range(50)) + passage + "€" * i, 0) for i in range(5)]
    docs = spark.createDataFrame(rows + [(9, None, 3)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: r for r in suffix.cleaned_documents(docs).collect()}
    assert len(got) == 6 and got[9].text == ""
    for i, t, _ in rows:
        assert got[i].n_chars == len(got[i].text) < len(t) and passage[5:-5] not in got[i].text and got[i].text.startswith(t[:49])


def test_suffix_edge_cases(odd):
    got = suffix.cleaned_documents(odd)
    assert got.columns == odd.columns and got.count() == len(ODD)
    assert suffix.cleaned_documents(odd.where("false")).collect() == []


# pipeline --------------------------------------------------------------------


def test_pipeline_stages(spark, tok, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = docs
        assert name == "packing" or docs.columns == columns
    rows = {k: [r.asDict() for r in d.collect()] for k, d in seen.items()}
    kept = {r["doc_id"]: r["text"] for r in rows["quality_rules"]}
    want = components({k: shingle_set(t) for k, t in kept.items()})
    assert sorted(r["doc_id"] for r in rows["near_dedup"]) == sorted(k for k, c in want.items() if k == c)
    before = {r["doc_id"]: r["text"] for r in rows["near_dedup"]}
    after = {r["doc_id"]: r["text"] for r in rows["suffix_dedup"]}
    bounds = dict(zip(before, cut(list(before.values()), 200)))
    assert before.keys() == after.keys()
    for k, (n_bytes, removed, spans, _) in bounds.items():
        left = len(after[k].encode()) - (n_bytes - removed)
        assert 0 <= left <= 6 * spans
    words = Counter()
    for r in rows["mixing"]:
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert all(n <= 3 * len(WORD.findall(after[k])) for k, n in words.items())
    assert abs(sum(words.values()) - sum(len(WORD.findall(t)) for t in after.values())) <= 40
    mixed = defaultdict(list)
    for r in rows["mixing"]:
        mixed[r["doc_id"]].append(len(tok.encode(r["text"], add_special_tokens=False).ids) + 1)
    packed = Counter()
    for p in rows["packing"]:
        packed[p["doc_id"]] += p["length"]
    assert packed == {k: sum(v) for k, v in mixed.items()}


def test_pipeline_query(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
